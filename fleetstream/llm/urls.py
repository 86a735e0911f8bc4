"""URL filter: rules first, then a word model of host and path.

A host such as ``cheappillsonline.example.com`` holds words without separators. A unigram
Viterbi search splits every piece of a host or path into the words of highest joint
probability. Words are a fixed vocabulary, which has a fixed share of the probability, and
the pieces of the hosts of all pages, by their share of different hosts; so a table with
every count a thousand times as large gives the same splits. A multinomial naive Bayes
model trained on the labelled vocabulary then scores the words of host and path.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from fleetstream.llm.storage import broadcast_if_small, written

# The labelled vocabulary that the model is trained on.
BLOCK_WORDS = """
ads adult adware affiliate affiliates bet bets betting bingo bitcoin bonus casino casinos
cheap cialis clickbait clicks coupon coupons crack cracked deal deals dating doorway escort
escorts farm forex free gambling gamble hack hacked hookup jackpot keygen loan loans lottery
lotto malware money naked nude nudes offer offers payday pharma pharmacy phishing pill pills
poker popup popups porn porno pornos promo rich scam sex sexy slot slots spam spammer spyware
sweepstakes torrent torrents track tracker trackers tracking viagra virus warez weightloss win
winner wins xxx
""".split()
ALLOW_WORDS = """
academy art article articles author bank book books business city club code community company
college contact course culture data edu education events faq family food garden guide guides
health history house journal lab library life local museum music news office open paper papers
people press project projects research school science sport sports state student students team
tech times today town travel university weather wiki work world
""".split()
# Words that are in hosts and paths of any kind. They are found in a piece
# like the others, but a label for them would let the frame of a url outvote its name.
FRAME_WORDS = """
about archive blog blogs de dev docs en es forum fr help home htm html index info it m mail map
maps media mobile net online org page pages search service services shop static store support the
web www
""".split()
#: What the vocabulary has of the probability of all words; the rest is the hosts' pieces'.
VOCABULARY_SHARE = 0.5
#: What any word has besides, a tenth of it for each letter.
UNKNOWN_SHARE = 1e-6
#: A piece may be a word of its own if at least so many different hosts have it.
LEAST_HOSTS = 3
#: Shorter pieces of hosts don't show that a longer one is made of words.
LEAST_PART = 3
#: Longest word that the segmentation looks for.
LONGEST_WORD = 24

_WORDS = re.compile(r"[a-z]+")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """The longest fitting rule, or null. A rule is ``host/path prefix``.

    It fits its host and every subdomain of it. The list becomes one expression; it is
    meant for some hundreds of rules.
    """
    fits = []
    for rule in sorted(set(rules), key=lambda r: (-len(r), r)):
        name, slash, rest = rule.partition("/")
        on_host = (host == name) | host.endswith("." + name)
        fits.append(F.when(on_host & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def word_counts(pages: DataFrame) -> DataFrame:
    """w, n: pieces of letters between separators in hosts, by number of different hosts.

    Pieces longer than a word can be count for nothing.
    """
    host = host_of(F.coalesce("url", F.lit("")))
    pieces = (
        pages.select(host.alias("_host"))
        .distinct()
        .select("_host", F.explode(F.regexp_extract_all("_host", F.lit("([a-z]+)"), 1)).alias("w"))
        .where(F.length("w") <= LONGEST_WORD)
    )
    counted = pieces.distinct().groupBy("w").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_HOSTS)


_LABELLED = frozenset(BLOCK_WORDS) | frozenset(ALLOW_WORDS)
_VOCABULARY = _LABELLED | frozenset(FRAME_WORDS)


def parts_of(piece: str) -> set[str]:
    """Everything in a piece that could be a word."""
    n = len(piece)
    return {piece[i:j] for i in range(n) for j in range(i + 1, min(n, i + LONGEST_WORD) + 1)}


class WordSplitter:
    """The most probable split of a piece into words.

    ``counts`` has the hosts' pieces, or those that a piece to be split has in it, and
    ``total`` the sum over all of them.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None):
        self._counts = counts
        self._total = max(1, sum(counts.values()) if total is None else total)
        self._logs: dict[str, float] = {}
        self.split = lru_cache(maxsize=100_000)(self._split)

    def _is_made_of_words(self, piece: str) -> bool:
        """Whether two or more words make the piece: of the vocabulary, or pieces that at
        least as many hosts have."""
        least, reached = self._counts[piece], [True]
        for end in range(1, len(piece) + 1):
            reached.append(any(
                reached[s]
                and end - s < len(piece)
                and (
                    (part := piece[s:end]) in _VOCABULARY
                    or (end - s >= LEAST_PART and self._counts.get(part, 0) >= least)
                )
                for s in range(end)
            ))
        return reached[-1]

    def _score(self, word: str) -> float:
        log = self._logs.get(word)
        if log is None:
            # An unknown word gets less the longer it is.
            share = UNKNOWN_SHARE * 10.0 ** -min(len(word), LONGEST_WORD)
            if word in _VOCABULARY:
                share += VOCABULARY_SHARE / len(_VOCABULARY)
            if (n := self._counts.get(word)) and not self._is_made_of_words(word):
                share += (1 - VOCABULARY_SHARE) * n / self._total
            log = self._logs[word] = math.log(share)
        return log

    def _split(self, piece: str) -> tuple[str, ...]:
        if piece in _VOCABULARY:
            return (piece,)
        best: list[tuple[float, int]] = [(0.0, 0)]
        for end in range(1, len(piece) + 1):
            starts = range(max(0, end - LONGEST_WORD), end)
            best.append(
                max((best[s][0] + self._score(piece[s:end]), -s) for s in starts)
            )
        words, end = [], len(piece)
        while end:
            start = -best[end][1]
            words.append(piece[start:end])
            end = start
        return tuple(reversed(words))


def _odds_of_words() -> dict[str, float]:
    """Log odds for a block with add-one smoothing."""
    log = lambda words, w: math.log(
        (words.count(w) + 1) / (len(words) + len(_LABELLED))
    )
    # Words outside the labelled vocabulary speak for neither side.
    return {w: log(BLOCK_WORDS, w) - log(ALLOW_WORDS, w) for w in _LABELLED}


_ODDS = _odds_of_words()
_ANY_WORD = re.compile("|".join(sorted(_VOCABULARY)))


class UrlModel:
    """Multinomial naive Bayes with add-one smoothing over segmented words."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        self.splitter = WordSplitter(counts, total)

    def words(self, text: str) -> list[str]:
        return [w for p in _WORDS.findall(text.lower()) for w in self.splitter.split(p)]

    def block_odds(self, host: str, path: str) -> float:
        """Log odds for a block. Single letters count only as a piece of their own."""
        return math.fsum(_ODDS.get(w, 0.0) for w in self.words(host) + self.words(path))


def _read(urls: DataFrame) -> DataFrame:
    """The rows with _odds, of pieces that are a word of the vocabulary, and _open, the
    pieces that have such a word in them, as text: what no count is needed for is done."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        @lru_cache(maxsize=100_000)
        def of(text: str) -> tuple[float, tuple[str, ...]]:
            pieces = _WORDS.findall(text.lower())
            more = (p for p in pieces if p not in _VOCABULARY and _ANY_WORD.search(p))
            return math.fsum(_ODDS.get(p, 0.0) for p in pieces), tuple(more)

        for batch in batches:
            found = [
                list(map(of, (h, *p.split("/")))) for h, p in zip(batch["host"], batch["path"])
            ]
            batch["_odds"] = [math.fsum(x for x, _ in each) for each in found]
            batch["_open"] = [" ".join(sorted(p for _, ps in each for p in ps)) for each in found]
            yield batch

    kind = urls.schema["page_id"].dataType.simpleString()
    return urls.mapInPandas(
        read, f"page_id {kind}, host string, path string, _odds double, _open string"
    )


def _piece_odds(pieces: DataFrame, counts: DataFrame) -> DataFrame:
    """piece, odds of different pieces, by the counts of what each has in it.

    ``counts`` is a stored table. Parts move with a hash of their piece, so a very long
    piece costs its parts and no more.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    key = F.md5("piece")

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, piece in zip(batch["k"], batch["piece"]):
                some = sorted(parts_of(piece))
                for at in range(0, len(some), 10_000):
                    yield pd.DataFrame({"k": k, "w": some[at : at + 10_000]})

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            odds = []
            for piece, words, ns in zip(batch["piece"], batch["ws"], batch["ns"]):
                found = {} if words is None else dict(zip(words, map(int, ns)))
                odds.append(UrlModel(found, total).block_odds(piece, ""))
            yield pd.DataFrame({"piece": batch["piece"], "odds": odds})

    keyed = pieces.select(key.alias("k"), "piece")
    found = (
        keyed.mapInPandas(parts, "k string, w string")
        .join(broadcast_if_small(counts), "w")
        .groupBy("k")
        .agg(F.collect_list(F.struct("w", "n")).alias("found"))
        .select("k", F.col("found.w").alias("ws"), F.col("found.n").alias("ns"))
    )
    return keyed.join(found, "k", "left").select("piece", "ws", "ns").mapInPandas(
        judge, "piece string, odds double"
    )


def judged_urls(
    pages: DataFrame, allow: Sequence[str] = (), block: Sequence[str] = ()
) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.

    A null url or one without ``://`` has an empty host and path and is allowed unless a
    rule says otherwise. Repeated rows are judged alike; no rows give no rows. A rule in
    both lists blocks.
    """
    url = F.coalesce("url", F.lit(""))
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    read = _read(parsed)
    # Different lists of pieces, and of those the different pieces.
    lists = written(read.where("_open != ''").select("_open").distinct(), "open")
    listed = lists.select("_open", F.explode(F.split("_open", " ")).alias("piece"))
    counts = written(word_counts(pages), "words")
    odds = written(_piece_odds(listed.select("piece").distinct(), counts), "odds")
    sums = listed.join(broadcast_if_small(odds), "piece").groupBy("_open").agg(
        # In order, so that the order of additions doesn't show.
        F.aggregate(F.array_sort(F.collect_list("odds")), F.lit(0.0), lambda x, y: x + y).alias("_more")
    )
    scored = (
        read.join(broadcast_if_small(written(sums, "sums")), "_open", "left")
        .withColumn("block_odds", F.col("_odds") + F.coalesce("_more", F.lit(0.0)))
    )
    rule = rule_of(F.col("host"), F.col("path"), [*allow, *block])
    blocked = F.col("rule").isin(list(block)) if block else F.lit(False)
    verdict = (
        F.when(F.col("rule").isNotNull(), F.when(blocked, "block").otherwise("allow"))
        .when(F.col("block_odds") > 0, "block")
        .otherwise("allow")
    )
    return scored.withColumn("rule", rule).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "block_odds"
    )
