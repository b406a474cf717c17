import gzip
import json
import random
import zlib
from urllib.request import url2pathname

import pytest

from tidelog.llm import preference, url_filter, warc
from tidelog.llm.catalog import URL_RULES
from tidelog.llm.components import written


def ordered(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://a.example/x", "<p>same</p>", 1),
        (2, "http://a.example/y z\r\nWARC-Type: evil", "<p>same</p>", 2),
        (3, None, None, 3),
        (4, "http://b.example/é", "", 4),
        (5, "http://b.example/", "ä" * 400_000 + "\r\n\r\nWARC/1.1\r\n", 5),
        (6, "u", "<p>same</p>", 6),
        (6, "u", "<p>same</p>", 6),
        (None, "u", "<p>same</p>", 7),
        (None, "u", "only without id", 8),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload int")


def expected(rows, min_bytes=0):
    payloads = [(r.page_id, (r.html or "").encode()) for r in rows]
    out = []
    for page_id, payload in payloads:
        ids = [i for i, p in payloads if p == payload and i is not None]
        top = max(ids, default=None)
        own = page_id == top or top is None or len(payload) < min_bytes
        out.append((page_id, len(payload), warc.digest_of(payload), "response" if own else "revisit", None if own else top))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, pages, min_bytes):
    got = warc.round_trip(spark, pages, min_bytes).drop("url")
    assert ordered(got) == expected(pages.collect(), min_bytes)


def test_no_pages(spark, pages):
    assert warc.round_trip(spark, pages.limit(0)).collect() == []


def local(uri):
    return url2pathname(uri.removeprefix("file://"))


def test_archives_and_index(spark, pages, tmp_path):
    """One member a record, the same bytes as before, and offsets that the index file knows."""
    rows = warc.with_references(spark, pages.coalesce(1))
    manifest = written(spark, warc.write_archives(rows.coalesce(1), f"file://{tmp_path}/archives", 1000), "manifest")
    assert manifest.count() > 1 and sum(r.records for r in manifest.collect()) == pages.count()
    index = warc.normalise(spark, manifest).collect()
    whole = sorted(gzip.open(local(r.archive)).read() for r in manifest.collect())
    for archive in {r.archive for r in index}:
        data = open(local(archive), "rb").read()
        mine = sorted((r for r in index if r.archive == archive), key=lambda r: r.offset)
        assert [r.asDict() for r in mine] == [json.loads(line) for line in open(local(archive) + ".index")]
        members = [data[r.offset : r.offset + r.length] for r in mine]
        assert b"".join(members) == data
        parts = [zlib.decompress(m, 31) for m in members]
        assert all(p.startswith(b"WARC/1.1\r\n") and p.endswith(b"\r\n\r\n") for p in parts)
        assert b"".join(parts) in whole
    # an archive that has members already normalises to the same records
    again = spark.createDataFrame([(r,) for r in {r.archive for r in index}], "archive string")
    assert ordered(warc.read_records(warc.normalise(spark, again))) == ordered(
        warc.read_records(spark.createDataFrame(index, warc.INDEX))
    )


def test_cut_archive_stops(spark, pages, tmp_path):
    manifest = written(spark, warc.write_archives(warc.with_references(spark, pages), str(tmp_path)), "manifest")
    path = manifest.first().archive
    data = open(local(path), "rb").read()
    open(local(path), "wb").write(data[:-20])
    with pytest.raises(Exception, match="ends inside"):
        warc.normalise(spark, manifest)


def test_rules_and_parts(spark):
    urls = [
        ("http://X.Example.NET/en/1?q", "x.example.net", "/en/1", "example.net/en/", "allow"),
        ("https://example.net/de/1#a/b", "example.net", "/de/1", "net/", "block"),
        ("https://notexample.net/en/1", "notexample.net", "/en/1", "net/", "block"),
        ("http://b.example.com/de/", "b.example.com", "/de/", "example.com/de/", "block"),
        ("http://b.example.com/de", "b.example.com", "/de", None, None),
        ("http://some.org/fr/x\ny", "some.org", "/fr/x\ny", "org/fr/", "allow"),
        ("http://some.org?x=/fr/", "some.org", "", None, None),
        ("x://http://a.net/", "http:", "//a.net/", None, None),
        ("nothing here", "", "", None, None),
        (None, "", "", None, None),
        ("http://ÄB.net/", "Äb.net", "/", "net/", "block"),
        ("http://net", "net", "", None, None),
    ]
    df = spark.createDataFrame([(i, u[0], "x") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r.page_id: r for r in url_filter.judge_urls(spark, df, URL_RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if rule else got[i].verdict in ("allow", "block")


def test_templates(spark):
    rows = [f"http://h.example.com/de/a/{i}" for i in range(9)] + [f"http://h.example.com/en/{w}" for w in "abcdefghij"]
    rows += [f"http://h.example.com/de/b/x{i}.html" for i in range(3)] + ["http://h.example.com/a/b/c/d/e/f"] * 2
    rows += ["http://calm.example.com/en/1", None, None]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = url_filter.judge_urls(spark, df, URL_RULES).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[0].template == "/de/a/*" and by[9].template == "/en/*" and by[19].template == "/de/b/x*.html"
    assert by[22].template == "/a/b/c/d/**"
    # no label of its own: the share of its host, almost all blocked, decides
    assert by[9].verdict == "block" and by[22].verdict == "block"
    assert url_filter.judge_urls(spark, df.limit(0), URL_RULES).collect() == []


def test_deep_paths_with_labels_of_both_kinds(spark):
    rules = [("h.example", "/deny", "block"), ("h.example", "/a/b/c/d/e/spam/1", "block"), ("h.example", "/a/b/c/d/e/good/1", "allow")]
    rules += [("g.example", "/", "block"), ("g.example", "/a/b/c/d/e/f/good/1", "allow"), ("k.example", "/p/q/r/s/t/u/v/w", "block")]
    rows = [f"http://h.example/a/b/c/d/e/{kind}/{i}" for kind in ("spam", "good") for i in range(10, 30)]
    rows += [f"http://g.example/a/b/c/d/e/f/{kind}/{i}" for kind in ("spam", "good") for i in range(10, 20)]
    rows += [f"http://k.example/p/q/r/s/t/u/v/w/{i}" for i in range(4)] + [f"http://k.example/p/q/r/s/t/u/v/x/{i}" for i in range(4)]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = url_filter.judge_urls(spark, df, rules).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.host != "k.example":
            kind = r.path.split("/")[-2]
            assert r.verdict == ("block" if kind == "spam" else "allow"), r
            assert f"/{kind}/" in r.template
        else:
            assert f"/{r.path.split('/')[8]}/" in r.template


def test_branches_merge_by_a_test_of_their_counts(spark):
    rules = [("h.example", "/", "block"), ("h.example", "/m/large/ok", "allow"), ("h.example", "/m/small/ok", "allow")]
    rules += [("h.example", "/m/other/ok", "allow"), ("h.example", "/n/", "allow"), ("h.example", "/p/", "allow")]
    ways = {"/m/large/ok": 1100, "/m/large/no": 900, "/m/small/ok": 1, "/m/small/no": 1}
    ways |= {"/m/other/ok": 300, "/m/other/no": 1700, "/n/x": 40, "/p/y": 2, "/q/z": 0}
    counts = [(f"x://h.example{way}", n) for way, n in ways.items() if n] + [("x://free.example/q", 3)]
    df = spark.createDataFrame(counts, "url string, n int").selectExpr("explode(sequence(1, n)) page_id", "url")
    got = url_filter.judge_urls(spark, df, rules)
    branch = {r.template: r.branch for r in got.select("template", "branch").distinct().collect()}
    # ok and no differ under large and other; two labels under small do not
    assert branch["/m/large/ok"] != branch["/m/large/no"] and branch["/m/other/ok"] != branch["/m/other/no"]
    assert branch["/m/small/ok"] == branch["/m/small/no"]
    # mixed nodes stay apart, whole ones merge at the root
    assert branch["/n/x"] == branch["/p/y"] and len({branch["/m/large/ok"], branch["/m/other/ok"], branch["/n/x"]}) == 3


def _merged_by_hand(leaves):
    """{template: branch}, node by node."""
    branch = {t: t for t, _, _ in leaves}
    steps = {t: (t + "/").split("/") for t in branch}
    for depth in range(max(map(len, steps.values())), 1, -1):
        nodes = {}
        for t, n, b in leaves:
            if len(steps[t]) >= depth:
                nodes.setdefault(tuple(steps[t][: depth - 1]), {}).setdefault(steps[t][depth - 1], []).append((t, n, b))
        for kids in nodes.values():
            todo = [[k for k in kids.values() if len({branch[t] for t, _, _ in k}) == 1]]
            while todo:
                group, parts = todo.pop(), {}
                total, bad = (sum(x[i] for k in group for x in k) for i in (1, 2))
                for k in group:
                    n, b = (sum(x[i] for x in k) for i in (1, 2))
                    lean = b * (total - n) - (bad - b) * n
                    far = lean * lean * total > 3.84 * n * (total - n) * bad * (total - bad)
                    parts.setdefault((lean > 0) - (lean < 0) if far else 0, []).append(k)
                if len(parts) > 1:
                    todo += parts.values()
                else:
                    members = [t for k in group for t, _, _ in k]
                    branch |= dict.fromkeys(members, min((branch[t] for t in members), default=None))
    return branch


def test_near_shares_merge_and_far_ones_do_not(spark):
    rng = random.Random(5)
    walked = {}
    for _ in range(150):
        template = "".join(f"/{rng.choice('abcd')}" for _ in range(rng.randint(0, 4)))
        labels = rng.choice([0, 1, 3, 20, 400])
        walked[template] = (labels, sum(rng.random() < rng.choice([0.1, 0.5, 0.9]) for _ in range(labels)))
    hosts = {
        "near": [("/a", 2, 1), ("/b", 2000, 900), ("/b/x", 2000, 910)],
        "far": [("/a", 2, 1), ("/b", 2000, 900), ("/c", 2000, 1800), ("/d", 0, 0)],
        "three": [("/a", 1000, 900), ("/b", 1000, 600), ("/c", 1000, 100), ("/d", 1000, 100)],
        "walked": [(t, *counts) for t, counts in walked.items()],
        "": [("", 0, 0)],
    }
    given = [(host, *leaf) for host, leaves in hosts.items() for leaf in leaves]
    given = spark.createDataFrame(given, "host string, template string, labels long, blocked long")
    got = {host: {} for host in hosts}
    for r in url_filter._merge(spark, given).collect():
        got[r.host][r.template] = r.branch
    assert got == {host: _merged_by_hand(leaves) for host, leaves in hosts.items()}
    assert got["near"] == {"/a": "/a", "/b": "/a", "/b/x": "/a"}
    # between two that differ, what differs from neither stays with others like it
    assert got["far"] == {"/a": "/a", "/d": "/a", "/b": "/b", "/c": "/c"}
    # all of three large ones come apart though two lie above the rest
    assert got["three"] == {"/a": "/a", "/b": "/b", "/c": "/c", "/d": "/c"}
    assert 1 < len(set(got["walked"].values())) < len(walked)


def test_templates_without_labels(spark):
    df = spark.createDataFrame([(1, "http://a.example.com/x"), (None, "http://a.example.com/x")], "page_id long, url string")
    got = url_filter.judge_urls(spark, df, URL_RULES).collect()
    assert sorted((r.page_id is None, r.verdict) for r in got) == [(False, "allow"), (True, "allow")]


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, prompt string")


def test_preference_pairs(spark):
    rows = [
        (0, 0, "user", "hi", "x"), (0, 1, "assistant", "A0", "x"), (0, 1, "assistant", "A0", "x"), (0, 2, "user", "more", "x"),
        (1, 0, "user", "yo", "x"), (1, 1, "assistant", "B <|im_end|>", "x"),
        (2, 0, "user", "alone", "x"), (2, 1, "assistant", "C", "x"),
        (4, 0, "user", "never", "x"), (5, 0, None, None, "x"), (5, 1, "assistant", "D", "x"),
        (None, 0, "user", "lost", "x"), (6, None, "assistant", "E", "x"), (7, 0, "assistant", "E", "x"),
    ]
    pairs = preference.format_pairs(preference.swapped_answers(preference.conversations(turns(spark, rows))))
    got = {r.pair_id: r for r in pairs.collect()}
    shown = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert set(got) == {0, 1, 2, 4, 5, 6, 7}
    assert got[0].prompt == shown("user", "hi") and got[0].prompt_turns == 1
    assert got[0].chosen == shown("assistant", "A0") + shown("user", "more")
    assert got[0].rejected == shown("assistant", "B < |im_end|>") + shown("user", "more")
    for side in ("chosen", "rejected"):
        text, spans = got[0][side], got[0][f"{side}_spans"]
        assert [text[s.start : s.end] for s in spans] == [text.split("\n")[1]]
    assert (got[2].chosen, got[2].rejected) == (shown("assistant", "C"), "")
    assert got[4].tied and got[4].chosen == got[4].rejected == "" and got[4].prompt == shown("user", "never")
    assert got[5].prompt == shown("", "") and got[5].rejected == ""
    assert got[6].tied and got[7].tied
    none = preference.conversations(turns(spark, rows).limit(0))
    assert preference.format_pairs(preference.swapped_answers(none)).collect() == []


def test_prefix_of_unequal_and_missing_sides(spark):
    kind = "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>"
    a, b, c = ("user", "a"), ("assistant", "b"), ("assistant", None)
    rows = [(1, [a, b], [a]), (2, [a, c], [a, c, b]), (3, None, [a]), (4, [], None), (5, [b, a], [a, b])]
    got = {r.pair_id: r for r in preference.format_pairs(spark.createDataFrame(rows, kind)).collect()}
    assert {i: r.prompt_turns for i, r in got.items()} == {1: 1, 2: 2, 3: 0, 4: 0, 5: 0}
    assert {i: r.tied for i, r in got.items()} == {1: False, 2: False, 3: False, 4: True, 5: False}
    assert got[2].chosen == "" and got[2].rejected.endswith("b<|im_end|>\n")
    assert len(got[5].chosen_spans) == len(got[5].rejected_spans) == 1
