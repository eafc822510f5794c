"""URL filters against enumerating every token combination."""

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

from lotwise.llm import urlrules
from lotwise.llm.catalog import URL_RULES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (m.group(1).translate(LOWER), m.group(2)) if m else ("", "")


def plain_stated(url):
    host, path = split(url)
    best = None
    for rule, verdict in URL_RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return best


def plain_tokens(url):
    if url is None or "://" not in url:
        return set()
    host, path = split(url)
    out = []
    m = re.match(r"([A-Za-z][A-Za-z0-9+.-]{0,15})://", url)
    out += [("scheme", m.group(1).translate(LOWER))] if m else []
    labels = host.split(".")
    out += [("host", ".".join(labels[i:])) for i in range(len(labels))] if len(host) <= 253 else [("host", host)]
    parts = [x for x in path.split("/") if x]
    shown = ["0" if re.fullmatch("[0-9]+", x) else x for x in parts]
    out += [("path", x) for x in shown] + [("first", x) for x in shown[:1]]
    ending = re.search(r"\.[A-Za-z0-9]{1,5}$", parts[-1]) if parts else None
    out += [("ending", ending.group())] if ending else []
    query = re.search(r"://[^?#]*\?([^#]*)", url)
    out += [("query", x.split("=")[0]) for x in query.group(1).split("&")] if query else []
    out += [("fragment", "yes")] if "#" in url else []
    import hashlib

    return {f"{k} {hashlib.sha256(v.encode()).hexdigest() if len(v) > 64 else v}" for k, v in out if v}


def plain_rules(labelled, s):
    rows = sorted({(u, v) for u, v in labelled if u is not None and v is not None})
    n = len(rows)
    sets = [(plain_tokens(u), v) for u, v in rows]
    base = Counter(v for _, v in rows)
    count, by_label = Counter(), defaultdict(Counter)
    for t, v in sets:
        count.update(t)
        for x in t:
            by_label[x][v] += 1
    tilt = {t: max(m / count[t] - base[v] / n for v, m in by_label[t].items()) for t in count if count[t] >= s.support * n}
    baskets = []
    for t, v in sets:
        best = sorted(((tilt[x], count[x], x) for x in t if x in tilt), reverse=True)[: s.combined]
        if best:
            baskets.append(([x for *_, x in best], v))
    labels, met, with_label = Counter(v for _, v in baskets), Counter(), Counter()
    for items, v in baskets:
        for k in range(1, len(items) + 1):
            for part in combinations(sorted(items), k):
                met[part] += 1
                with_label[part, v] += 1
    rules = {}
    for (part, v), m in with_label.items():
        confidence = m / met[part]
        if m >= s.support * n and confidence >= s.confidence and confidence / (labels[v] / len(baskets)) > 1:
            rules[part, v] = (confidence, m)
    return {
        (part, v): x
        for (part, v), x in rules.items()
        if not any(w == v and len(q) < len(part) and set(q) < set(part) and y[0] >= x[0] for (q, w), y in rules.items())
    }


def _urls():
    rng = random.Random(5)
    urls = [None, "", "nonsense", "://", "http://", "https://Example.ORG", "http://example.org/es/", "http://ORG/x"]
    urls += ["http://xorg/y", "ftp://a.org:80/en/1", "http://x.org/a://b.com/de/", "HTTP://É.example.org/EN/1?q"]
    urls += ["http://" + "a." * 200 + "com/de/1", "http://x.net/" + "y" * 500, "http://long.net/" + "p/" * 30_000]
    urls += ["http://h.com/de\n/x", "http://q.com?x=1&y&=3&x=2#f#g", "?a://b.org/?", "http://user@x.example.org/en/12/"]
    for _ in range(400):
        host = rng.choice(["www.", "", "blog."]) + rng.choice(["aa", "bb", "cc", "spam"]) + rng.choice([".example", ""])
        url = rng.choice(["http", "https"]) + "://" + host + rng.choice([".com", ".org", ".net"])
        url += f"/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.randrange(300)}"
        urls.append(url + rng.choice(["", "/", ".html", "?page=2&ref=x", "#top"]))
    return urls


def test_parts_and_stated_rules(spark):
    urls = _urls()
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    none = spark.createDataFrame([], urlrules.RULES)
    got = urlrules.judged(pages, none, URL_RULES).select("url", "url_filter.*", urlrules.tokens(pages["url"]).alias("t")).collect()
    assert len(got) == len(urls)
    for r in got:
        best = plain_stated(r["url"])
        assert (r["host"], r["path"]) == split(r["url"])
        assert (r["rule"], r["verdict"]) == (best or (None, "allow")) and r["learned"] is None
        assert set(r["t"]) == plain_tokens(r["url"]) and len(set(r["t"])) == len(r["t"])


def test_mined_rules_and_verdicts(spark):
    s = urlrules.Settings(support=0.01, combined=5, buckets=16)
    urls = _urls()
    rng = random.Random(6)
    labelled = [(u, best[1]) for u in urls if (best := plain_stated(u))]
    labelled += [(u, rng.choice(["allow", "block", None])) for u in urls[::9]] + labelled[:50]
    frame = spark.createDataFrame(labelled, "url string, label string")
    rules = urlrules.mine(frame, s)
    got = {(tuple(r["tokens"]), r["verdict"]): (r["confidence"], r["support"]) for r in rules.collect()}
    want = plain_rules(labelled, s)
    assert got == want and len({v for _, v in want}) == 2

    pages = spark.createDataFrame([(u, 1, 2) for u in urls + urls[30:50]], "url string, URL_FILTER int, _index int")
    out = urlrules.judged(pages, rules, URL_RULES, s)
    assert out.columns == [*pages.columns, "url_filter_"]
    for r in out.collect():
        own = plain_tokens(r["url"])
        fit = [(*x, list(part), v) for (part, v), x in want.items() if set(part) <= own]
        learned = max(fit) if fit else None
        best = plain_stated(r["url"])
        f = r["url_filter_"]
        assert f["verdict"] == (best[1] if best else learned[3] if learned else "allow")
        assert (f["learned"] and (f["learned"]["confidence"], f["learned"]["support"], f["learned"]["tokens"], f["learned"]["verdict"])) == learned
    plan = out._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_no_labels_and_no_rows(spark):
    frame = spark.createDataFrame([(None, "allow"), ("http://a.com/", None)], "url string, label string")
    rules = urlrules.mine(frame)
    assert rules.count() == 0
    one = urlrules.mine(spark.createDataFrame([("no address", "block")], "url string, label string"))
    pages = spark.createDataFrame([("http://a.com/",)], "url string")
    assert urlrules.judged(pages, one).first()["url_filter"]["verdict"] == "allow"
    assert urlrules.judged(pages.limit(0), rules, URL_RULES).count() == 0


def test_no_address_and_no_token_is_left_out_by_default(spark):
    """Beyond the bounds that a caller may set: every labelled address, every token of it."""
    rng = random.Random(7)
    labelled = []
    for i in range(900):
        parts = [f"p{k}" for k in range(10) if rng.random() < 0.5]
        verdict = "block" if {"p3", "p8"} <= set(parts) or rng.random() < 0.05 else "allow"
        # twin and pair always come together
        labelled.append((f"https://www.h{i % 3}.net/" + "/".join([*parts, *(["twin", "pair"] if i % 4 == 0 else []), str(i)]), verdict))
    s = urlrules.Settings(support=0.03)
    assert s.labelled is None and s.combined is None
    rules = urlrules.mine(spark.createDataFrame(labelled, "url string, label string"), s)
    got = {(tuple(r["tokens"]), r["verdict"]): (r["confidence"], r["support"]) for r in rules.collect()}
    assert got == plain_rules(labelled, s) and len(got) == rules.count()
    assert (("path p3", "path p8"), "block") in got
    capped = urlrules.mine(spark.createDataFrame(labelled, "url string, label string"), urlrules.Settings(support=0.03, combined=4))
    assert {tuple(r["tokens"]) for r in capped.collect()} != {k for k, _ in got}
