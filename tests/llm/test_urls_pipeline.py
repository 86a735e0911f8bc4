import math
import re

import pytest

from fleetstream.llm import urls
from fleetstream.llm.queries import ALLOW_RULES, BLOCK_RULES
from tests.llm.conftest import SF

RULES = {r: "allow" for r in ALLOW_RULES} | {r: "block" for r in BLOCK_RULES}


def _parsed(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def _rule(host, path):
    fits = []
    for rule in RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(rule)
    return max(fits, key=len, default=None)


ODD = [
    None, "", "no scheme", "://", "http://", "HTTP://ExAmple.COM/en/x?y#z", "http://É.Com",
    "https://www.example.com/en/a://b", "x://a?b/c", "x://a#b/c", "http://notexample.com/en/",
    "http://a.net/es", "http://a.net/es/", "http://net/fr/1", "http://a.b.example.com/en/\nq",
    "http://example.com", "http://cheap-pills.org/x", "http://cheappillscasino.org/x",
    "http://x9.org/poker/casino", "http://schoolnews.net/en/1", "x://y" + "/z" * 40_000,
]


def _judged(df):
    return {r.page_id: r for r in urls.judged_urls(df, ALLOW_RULES, BLOCK_RULES).collect()}


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "page_id long, url string").repartition(3)
    got = _judged(df)
    for i, url in enumerate(ODD):
        host, path = _parsed(url)
        assert (got[i].host, got[i].path) == (host, path), url
        assert got[i].rule == _rule(host, path)
        if got[i].rule:
            assert got[i].verdict == RULES[got[i].rule]
    verdict = {ODD[i]: got[i].verdict for i in got}
    assert verdict["http://cheap-pills.org/x"] == verdict["http://cheappillscasino.org/x"] == "block"
    assert verdict["http://x9.org/poker/casino"] == "block"
    assert verdict["http://schoolnews.net/en/1"] == verdict[None] == "allow"


def test_segmentation_is_the_most_probable():
    model = urls.UrlModel({"the": 50, "there": 10, "rest": 20, "or": 30})
    split = model.splitter.split
    assert split("cheappills") == ("cheap", "pills")
    assert "".join(split("qqzxthere")) == "qqzxthere" and split("") == ()

    def best(piece):
        ways = [((), 0.0)]
        for mask in range(2 ** (len(piece) - 1) if piece else 0):
            cuts = [0, *[k + 1 for k in range(len(piece) - 1) if mask >> k & 1], len(piece)]
            words = tuple(piece[a:b] for a, b in zip(cuts, cuts[1:]))
            ways.append((words, sum(model.splitter._score(w) for w in words)))
        return max(w[1] for w in ways[1:])

    for piece in ("therest", "freebets", "casinoor", "xyzads", "newsblogs"):
        assert sum(map(model.splitter._score, split(piece))) == pytest.approx(best(piece))


@pytest.mark.parametrize("size", ["0.001", "0.01", "0.1"])
def test_real_pages(spark, size):
    df = spark.read.parquet(f"{SF.removesuffix('0.001')}{size}/pages.parquet")
    got = urls.judged_urls(df, ALLOW_RULES, BLOCK_RULES).collect()
    assert len(got) == df.count()
    for r in got:
        if r.rule is None:
            bad = re.search("casino|pills|bets|adult|spam|ads-", r.host)
            assert r.verdict == ("block" if bad else "allow"), r.host


def test_odds_like_naive_bayes_counted_by_hand():
    counts = {"acme": 4, "zq": 3}
    model = urls.UrlModel(counts)
    block, allow = urls.BLOCK_WORDS, urls.ALLOW_WORDS
    assert not set(block) & set(allow) and not set(urls.FRAME_WORDS) & {*block, *allow}
    labelled = {*block, *allow}

    def odds(words):
        total = 0.0
        for w in words:
            if w in labelled:
                p = [(side.count(w) + 1) / (len(side) + len(labelled)) for side in (block, allow)]
                total += math.log(p[0] / p[1])
        return total

    for host, path, words in (
        ("blog.adult-x.example.net", "/en/1.html", "blog adult x example net en html"),
        ("freecasino.acme.org", "/school", "free casino acme org school"),
        ("www.musicnews.net", "/win/win", "www music news net win win"),
        ("", "", ""),
    ):
        assert [w for w in model.words(host + path) if w in labelled] == [
            w for w in words.split() if w in labelled
        ]
        assert model.block_odds(host, path) == pytest.approx(odds(words.split()))
    assert model.block_odds("blog.adult-x.example.net", "/en/1.html") > 0
    assert model.block_odds("www.musicnews.net", "/en/") < 0


def test_repeated_rows_other_columns_none(spark):
    df = spark.createDataFrame([(1, "x://a.com/", "h"), (1, "x://a.com/", "h")], "page_id long, url string, host string")
    got = urls.judged_urls(df, ["com/"]).collect()
    assert [(r.host, r.rule, r.verdict) for r in got] == [("a.com", "com/", "allow")] * 2
    assert urls.judged_urls(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline
    from fleetstream.llm.storage import written

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        out[name] = docs
    return {k: (df.columns, df.collect()) for k, df in out.items()}


def test_stages_keep_the_columns(stages):
    columns = stages["documents"][0]
    for name in ("language", "near_duplicates", "substrings", "mixing"):
        assert stages[name][0] == columns


def test_stages_like_brute_force(stages):
    from tests.llm import brute

    rows = lambda name: [(r.doc_id, r.text) for r in stages[name][1]]
    assert len(rows("language")) >= 0.97 * len(rows("documents"))
    groups = brute.near_duplicates(rows("language"))
    assert {d for d, _ in rows("near_duplicates")} == {d for d, (_, c) in groups.items() if c == d}
    found = {
        d: (words, sha) for d, words, removed, sha in brute.substrings(rows("near_duplicates"))
        if removed < words or not removed
    }
    got = rows("substrings")
    assert {d for d, _ in got} == set(found)
    for d, text in got:
        kept = b" ".join(brute.WORD.findall(brute.utf8(text)))
        assert brute.sha(kept) == found[d][1]
    assert {d for d, _ in rows("mixing")} <= set(found)
    pieces = {(r.doc_id, r.piece) for r in stages["packing"][1]}
    assert {d for d, _ in pieces} == {d for d, _ in rows("mixing")}


def test_run_gives_the_last_stage(spark, stages):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages["packing"][0]
    digest = lambda rows: sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows)
    assert digest(got.collect()) == digest(stages["packing"][1])


def test_stages_take_odd_documents(spark):
    import corpus_pipeline
    from fleetstream.llm.storage import written

    rows = [
        (None, "the cat sat", "en", None, 3, 1), (1, None, None, "s", None, 2),
        (2, "", "en", "s", 0, 3), (3, "the " * 30, "en", "s", 9, 4), (3, "the " * 30, "en", "s", 9, 4),
        (4, "der Hund und die Katze im Haus " * 3, "de", "t", 9, 5),
    ]
    kind = "doc_id long, text string, lang string, source string, n_chars long, `_range` int"
    for some in (rows, []):
        docs = spark.createDataFrame(some, kind)
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF), name)
            if name != "packing":
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "_range"]
        assert (docs.count() > 0) == bool(some)


def test_table_size_does_not_change_the_split():
    some = {"cheappills": 4, "acmepills": 4, "acme": 90, "winchester": 40, "chester": 9, "com": 900}
    for times in (1, 1_000):
        split = urls.UrlModel({w: n * times for w, n in some.items()}).splitter.split
        assert split("cheappills") == ("cheap", "pills")
        assert split("acmepills") == ("acme", "pills")
        assert split("winchester") == ("winchester",)
        assert split("betscom") == ("bets", "com")


def test_verdicts_stay_when_the_table_grows(spark):
    names = [f"http://{x}/" for x in (
        "cheappills.org", "www.cheappills.org", "m.cheappills.org", "cheappills.info",
        "winnipeg.org", "www.winnipeg.org", "m.winnipeg.org", "winnipeg.info")]
    few = spark.createDataFrame(list(enumerate(names)), "page_id long, url string")
    for hosts in (100, 300_000):
        more = spark.range(hosts).selectExpr("-1 - id AS page_id", "concat('http://www.h', id, '.com/') AS url")
        got = urls.judged_urls(few.union(more)).where("page_id >= 0").collect()
        assert {r.verdict for r in got if "cheappills" in r.host} == {"block"}
        assert {r.verdict for r in got if "cheappills" not in r.host} == {"allow"}, hosts


def test_every_piece_may_be_a_word(spark):
    rows = [(i, f"x://{a}{k}.h/") for i, (a, k) in enumerate((a, k) for a in ("winter", "zz") for k in "123")]
    rows += [(10, "x://winterzz.h/winterzz")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    assert {r.w: r.n for r in urls.word_counts(df).collect()} == {"winter": 3, "zz": 3, "h": 7}
    assert {r.verdict for r in urls.judged_urls(df).collect()} == {"allow"}
