"""Language identification on small made-up languages."""

import random

import pytest

from lotwise.llm import language

SYLLABLES = {"aa": ["ka", "ro", "mi"], "bb": ["schu", "ter", "ung"], "cc": ["éa", "loi", "ñe"]}


def _text(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(documents):
    rng = random.Random(1)
    rows = [(i, _text(rng, lang := rng.choice(list(SYLLABLES)), 30), lang, "s") for i in range(200)]
    rows += [(300, None, "aa", "s"), (301, "!!", None, "s"), (None, "karo", "aa", "s")]
    return language.train(documents(rows))


def _predicted(spark, documents, model, texts):
    docs = documents([(i, t, None, None) for i, t in enumerate(texts)])
    read = docs.select("doc_id", language.predict(spark, docs["text"], model).alias("p")).collect()
    return [r["p"] for r in sorted(read, key=lambda r: r["doc_id"])]


def test_unseen_texts_and_unseen_words(spark, documents, model):
    rng = random.Random(2)
    wanted = [rng.choice(list(SYLLABLES)) for _ in range(60)]
    got = _predicted(spark, documents, model, [_text(rng, lang, 40).upper() for lang in wanted])
    assert [p["lang"] for p in got] == wanted and all(0 <= p["score"] <= 1 for p in got)
    # words longer than any learned one are read as character runs
    (p,) = _predicted(spark, documents, model, ["schuterungschuterungschuterung"])
    assert p["lang"] == "bb" and "schuterungschuterungschuterung" not in model.words


def test_texts_without_letters(spark, documents, model):
    got = _predicted(spark, documents, model, [None, "", "12 34 -- _", "漢字"])
    assert [p["lang"] for p in got[:3]] == ["und"] * 3 and [p["score"] for p in got[:3]] == [0.0] * 3
    assert got[3]["lang"] in SYLLABLES


def test_nothing_learned(spark, documents):
    docs = documents([(1, "karo", None, "s")])
    model = language.train(docs)
    assert _predicted(spark, documents, model, ["karo"])[0]["lang"] == "und"
    assert language.train(docs.limit(0)).languages == []


def test_backoff_takes_the_longest_known_run(model):
    reader = language.Reader(tuple(vars(model).values()))
    word = "schux"
    marked, total = f" {word} ", 0
    for at in range(len(marked)):
        runs = [marked[at : at + n] for n in range(model.longest, 0, -1) if at + n <= len(marked)]
        known = next((x for x in runs if x in model.runs), None)
        total = total + (model.run_scores[model.runs[known]] if known else model.floor)
    assert reader.backoff(word) == pytest.approx(total / len(marked))


def _category_words(text):
    import unicodedata

    out, held = [], ""
    for ch in (text or "").lower() + " ":
        if unicodedata.category(ch)[0] in "LM":
            held += ch
        else:
            if any(unicodedata.category(x)[0] == "L" for x in held):
                out.append(held)
            held = ""
    return out


def test_words_are_letters_with_their_marks():
    for text in ("½ ² Ⅷ ①", "नमस्ते दुनिया", "été ä ́", "İstanbul x2y", "ß_ſ-ﬁ", "漢字かな 한국어", None, ""):
        assert language.words_of(text) == _category_words(text)
    assert language.words_of("नमस्ते") == ["नमस्ते"] and language.words_of("½ ² Ⅷ ́") == []


def test_number_characters_have_no_language(spark, documents, model):
    got = _predicted(spark, documents, model, ["½", "²", "Ⅷ", "́", "karo ½"])
    assert [p["lang"] for p in got[:4]] == ["und"] * 4 and got[4]["lang"] == "aa"


def test_whole_prediction_against_plain_dictionaries(spark, documents):
    import math
    from collections import Counter

    rng = random.Random(7)
    rows = [(i, _text(rng, lang := rng.choice(list(SYLLABLES)), 30), lang, "s") for i in range(90)]
    rows += rows[:5] + [(200, "नमस्ते " * 9, "hi", "s"), (201, None, "hi", "s")]
    s = language.Settings(words=40, runs=60, longest=3)
    got_model = language.train(documents(rows).selectExpr("*", "1 AS _size", "2 AS _lang"), s)
    words, runs = {}, {}
    for lang in {r[2] for r in rows}:
        own = Counter(w for _, t, x, _ in rows if x == lang for w in _category_words(t))
        short = Counter()
        for w, n in own.items():
            for k in range(1, 4):
                for at in range(len(w) + 3 - k):
                    short[f" {w} "[at : at + k]] += n
        best = lambda c, k: dict(sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[:k])
        words[lang], runs[lang] = best(own, 40), best(short, 60)

    def logs(tables):
        items = {x for t in tables.values() for x in t}
        total = {lang: sum(t.get(x, 0) + 0.5 for x in items) + 1.0 for lang, t in tables.items()}
        return {x: {lang: math.log((t.get(x, 0) + 0.5) / total[lang]) for lang, t in tables.items()} for x in items}

    by_word, by_run = logs(words), logs(runs)
    floor = {lang: min(x[lang] for x in by_run.values()) - 1 for lang in words}

    def plain(text):
        found = _category_words(text)
        if not found:
            return "und", 0.0
        total = dict.fromkeys(words, 0.0)
        for w in found:
            marked = f" {w} "
            if w in by_word:
                part = by_word[w]
            else:
                parts = [
                    next((by_run[marked[at : at + k]] for k in (3, 2, 1) if at + k <= len(marked) and marked[at : at + k] in by_run), floor)
                    for at in range(len(marked))
                ]
                part = {lang: sum(x[lang] for x in parts) / len(marked) for lang in words}
            for lang in words:
                total[lang] += part[lang]
        odds = {lang: t / len(found) * min(len(found), s.evidence) for lang, t in total.items()}
        best = max(sorted(odds), key=odds.get)
        return best, 1 / sum(math.exp(o - odds[best]) for o in odds.values())

    texts = [_text(rng, rng.choice(list(SYLLABLES)), rng.randrange(1, 40)) for _ in range(40)]
    texts += ["नमस्ते xyz", "q", "KARO! schuter-ung 12", "ka " * 60_000, "x" * 50_000, None, "½", texts[0], texts[0]]
    for text, got in zip(texts, _predicted(spark, documents, got_model, texts)):
        lang, score = plain(text)
        assert got["lang"] == lang and got["score"] == pytest.approx(score, rel=1e-9)
