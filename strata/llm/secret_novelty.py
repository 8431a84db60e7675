"""Secret scan by dictionary-primed zstandard novelty.

Base spans come from three fixed patterns (assign, access, hex). Beyond them,
a candidate is a token of at least ``MIN_TOKEN`` characters that starts
within ``REACH`` code points after a sensitive word. Its novelty is the
number of bytes it adds to the compressed size of its surroundings, divided by
its length: zstandard is primed with a dictionary of the corpus's identifiers
(the words found in the most documents, counted over all of them) and
compresses the surrounding code without and with the candidate. Identifiers,
words and text that stands nearby are cheap; random keys cost about their own
length. Candidates at or above ``NOVEL_FROM`` are reported as kind ``novel``.

The dictionary is bounded (``DICTIONARY_WORDS`` words of 5 to 24 letters, so
it holds no keys) and is what each task gets; the counts behind it cover every
document. Text is read whole; positions are code points, ends exclusive.

Defined results. Null text: empty, no spans. A candidate that overlaps a base
span is left out. Spans are ordered by start, then kind (assign, access, hex,
novel). Each row is judged by itself, so repeated rows give repeated results;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Scratch

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")                 # the runs of [0-9a-f]+ that are long enough
MIN_ASSIGNED, MIN_ACCESS = 12, 18

# Words that make their surroundings sensitive.
SENSITIVE = re.compile(r"pass|pwd|secret|token|key|cred|auth|bearer|private|signature", re.I | re.A)
MIN_TOKEN, REACH, AROUND = 12, 48, 200
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN)
NOVEL_FROM = 0.7
DICTIONARY_WORDS = 6_000
WORD = re.compile(r"[A-Za-z_]{5,}")
COUNTED_WORDS = 200_000         # distinct words a task counts before it hands them on
LEVEL = 9


def identifiers(docs: DataFrame, *, text_col="text", words: int = DICTIONARY_WORDS) -> list[str]:
    """The words (5 to 24 letters or ``_``) found in the most documents,
    rarest first, as zstandard finds matches near the end of a dictionary
    cheapest. Ties go to the smaller word."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        table = lambda: pd.DataFrame({"w": pd.Series(list(counts), dtype=object), "n": list(counts.values())})
        for batch in batches:
            for t in batch["t"]:
                counts.update({w for w in WORD.findall(t) if len(w) <= 24})
                if len(counts) >= COUNTED_WORDS:
                    yield table()
                    counts.clear()
        yield table()

    scratch = Scratch()
    counted = (docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t")).mapInPandas(count, "w string, n long")
               .groupBy("w").agg(F.sum("n").alias("n")))
    counted = scratch.stage(counted, "identifier-counts")
    # how many words have which power of two of documents: the words that can
    # be among the first are few, so no task sends its own first ``words`` rows
    left, least = words, 0
    for r in sorted(counted.groupBy(F.log2("n").cast("int").alias("power")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        least, left = 2 ** r["power"], left - r["n"]
        if left <= 0:
            break
    first = counted.filter(F.col("n") >= least).orderBy(F.desc("n"), "w").limit(words).collect()
    scratch.drop(docs.sparkSession)
    return [r["w"] for r in first][::-1]


# What can match at all, for a whole batch in one linear pass of Arrow's
# regular expressions: most texts hold none of the three.
MAYBE = {"sensitive": f"(?i){SENSITIVE.pattern}", "access": "AKIA", "hex": "[0-9a-f]{16}"}


def base_spans(text: str, sensitive=True, access=True, hex=True) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns, leftmost without overlap
    within a kind, those too short dropped."""
    out = []
    if sensitive:                                  # holds every first word of an assignment
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGNED]
    if access:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if hex:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


class Novelty:
    """Marginal compressed bytes of a string within its surroundings."""

    def __init__(self, words: list[str], level: int = LEVEL):
        primed = " ".join(words).encode()
        given = None
        if len(primed) >= 8:
            given = zstandard.ZstdCompressionDict(primed, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            given.precompute_compress(level=level)
        self.compress = zstandard.ZstdCompressor(level=level, dict_data=given, write_content_size=False, write_dict_id=False).compress

    def __call__(self, text: str, start: int, end: int) -> float:
        before, after = text[max(0, start - AROUND):start], text[end:end + AROUND]
        size = lambda s: len(self.compress(s.encode("utf-8", "surrogatepass")))
        return (size(before + text[start:end] + after) - size(before + after)) / (end - start)


def spans(text: str, novelty: Novelty, sensitive=True, access=True, hex=True) -> list[tuple[int, int, int, float | None]]:
    """(start, kind, end, novelty) of every span of a text; the flags say
    what it may hold."""
    near = [m.end() for m in SENSITIVE.finditer(text)] if sensitive else []
    base = base_spans(text, sensitive, access, hex)
    out = [(*s, None) for s in base]
    starts, reach, seen = [s[0] for s in base], [], -1
    for s in base:                                 # furthest end so far
        reach.append(max(s[2], reach[-1] if reach else 0))
    for at in near:
        for m in TOKEN.finditer(text, max(at, seen + 1), at + REACH + MIN_TOKEN):     # starts at most REACH further on
            start, end = TOKEN.match(text, m.start()).span()
            seen = start
            k = bisect_right(starts, end - 1)
            if k and reach[k - 1] > start:
                continue
            value = novelty(text, start, end)
            if value >= NOVEL_FROM:
                out.append((start, 3, end, value))
    return sorted(out, key=lambda s: s[:3])


def scan(spark: SparkSession, text: Column, words: list[str]) -> Column:
    """struct(spans: array of (kind, start, end, novelty)) of a text column."""
    shared = spark.sparkContext.broadcast(list(words))

    @F.pandas_udf("spans array<struct<kind: string, start: long, end: long, novelty: double>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        novelty = Novelty(shared.value)
        for batch in batches:
            texts = pa.array(batch, pa.large_string())
            flags = [pc.match_substring_regex(texts, p).to_pylist() for p in MAYBE.values()]
            rows = [[{"kind": KINDS[k], "start": a, "end": z, "novelty": v} for a, k, z, v in spans(t, novelty, *f)] if any(f) else []
                    for t, *f in zip(batch, *flags, strict=True)]
            yield pd.DataFrame({"spans": pd.Series(rows, dtype=object)})

    return found(F.coalesce(text, F.lit("")))


def joined(found: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
