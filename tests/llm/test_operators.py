"""Each operator against a brute-force version, on small tables with nulls,
empty and long texts, ties, repeated rows, no rows, and columns whose names
clash with the operators' own."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from strata.llm import (
    bpe_bitmap, license_join, pivot_topk, simhash_tiles, spotsigs, toxic_segments, url_reputation, warc_chain,
    waterfill_mix, weak_quality,
)
from tests.llm import helpers as H

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, fp string, u string, copies string, key string"


def docs_of(spark, pairs, source=None):
    """Documents with extra columns named like the operators' own."""
    rows = [(i, t, "en", source(k) if source else "s", None, "x", "y", "z", "w", "v", "k") for k, (i, t) in enumerate(pairs)]
    return spark.createDataFrame(rows, DOCS)


LONG = " ".join(f"w{i % 977} and" for i in range(30_000))
ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, LONG), (6, "Released under the MIT License."), (6, "Released under the MIT License."),
       (None, "a null id with some words"), (None, "a null id with some words"), (None, None), (7, "tie tie"), (8, "tie tie"), (9, "é 中文 😀 \u2028 end")]


# --- op3 -------------------------------------------------------------------

@pytest.fixture(scope="module")
def tik():
    import base64

    import tiktoken
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


def test_bpe_equals_tiktoken(tik):
    codec = bpe_bitmap.Codec(tik[1], public_tokenizers.PATTERN)
    r = random.Random(4)
    texts = ["", "aaaa" * 5000, "the " * 500, " " * 3000 + "x", "'s 're don't", "\x1c\x85\xa0 x"]
    texts += ["".join(r.choice("aabce é中\n\t😀'²½0 ßÀ\u02c7.,!") for _ in range(r.randint(0, 90))) for _ in range(1500)]
    for t in texts:
        ids = codec.encode(t)
        assert ids == tik[0].encode_ordinary(t)
        assert codec.decode(ids) == t.encode()


def test_bpe_merges_stale_and_equal_ranks(tik):
    r = random.Random(5)
    for _ in range(600):
        piece = bytes(r.choice(b"abcth e") for _ in range(r.randint(1, 60)))
        assert b"".join(map(tik[0].decode_single_token_bytes, bpe_bitmap.merge_pretoken(piece, tik[1]))) == piece
        assert bpe_bitmap.merge_pretoken(piece, tik[1]) == tik[0]._encode_single_piece(piece)


def test_bpe_columns(spark, tik):
    args = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    df = docs_of(spark, ODD)
    got = df.select("text", bpe_bitmap.encode(spark, F.col("text"), *args).alias("ids")).select(
        "text", "ids", bpe_bitmap.decode(spark, F.col("ids"), *args).alias("back")).collect()
    for r in got:
        assert r["ids"] == tik[0].encode_ordinary(r["text"] or "")
        assert bytes(r["back"]) == (r["text"] or "").encode()
    assert df.limit(0).select(bpe_bitmap.round_trip(spark, F.col("text"), *args)).collect() == []


# --- op8 -------------------------------------------------------------------

def test_license_blocks_equal_brute_force(spark):
    r = random.Random(8)
    pool = sorted({w for _, t in license_join.TEMPLATES for w in t.split()}) + ["foo", "bar", "baz"]
    pairs = list(ODD)
    for i in range(60):
        w = [r.choice(pool) for _ in range(r.randint(0, 300))]
        if i % 2:
            at = r.randint(0, len(w))
            w[at:at] = r.choice(license_join.TEMPLATES)[1].split()
        pairs.append((100 + i, " ".join(w)))
    got = {}
    for x in license_join.scan(docs_of(spark, pairs)).collect():
        got.setdefault(x["doc_id"], []).append(x)
    assert sum(map(len, got.values())) == len(pairs)
    import re
    for i, t in pairs:
        w = re.findall(license_join.WORD, (t or "").translate(H.LOWER))
        want = set()
        for n, (_, text) in enumerate(license_join.TEMPLATES):
            words, window = set(text.split()), 64
            while window < 2 * len(text.split()):
                window *= 2
            for b, s in enumerate(range(0, len(w), window // 2)):
                block = set(w[s:s + window])
                if len(block & words) >= license_join.THRESHOLD * len(words) - 1e-9:
                    want.add((b, n, len(block & words) / len(words)))
        places = [(p, k) for p in license_join.PHRASES for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        assert any({(m["block"], m["template"], m["containment"]) for m in x["matches"]} == want
                   and x["n_words"] == len(w) and x["n_base"] == len(places)
                   and x["first_word"] == min((k for _, k in places), default=None)
                   and x["last_word"] == max((k for _, k in places), default=None)
                   and set(x["base_labels"]) == {license_join.PHRASES[p] for p, _ in places} for x in got[i])


@pytest.mark.parametrize("n", [33, 80, 300])
def test_license_templates_of_any_length(spark, n):
    """A template that stands whole in a text is found, wherever it stands."""
    text = " ".join(f"legal{k}" for k in range(n))
    pairs = [(at, " ".join(["x"] * at) + " " + text + " y z") for at in (0, 1, 9, 31, 32, 63, 64, 100, 511, 700)]
    pairs += [(1000, " ".join(text.split()[: n * 8 // 10])), (1001, None)]
    got = license_join.scan(docs_of(spark, pairs), templates=[*license_join.TEMPLATES, ("long", text)]).collect()
    assert {x["doc_id"]: x["labels"] for x in got} == {i: ["long"] if i < 1000 else [] for i, _ in pairs}


def test_license_phrases_that_overlap_themselves(spark):
    got = license_join.scan(docs_of(spark, [(1, "a a a a b a a"), (2, "a"), (3, "b a b a b"), (4, "")]), phrases={"a a": "x", "b a b": "y"})
    assert {x["doc_id"]: (x["n_base"], x["first_word"], x["last_word"]) for x in got.collect()} == {
        1: (4, 0, 5), 2: (0, None, None), 3: (2, 0, 2), 4: (0, None, None)}


def test_license_empty(spark):
    assert license_join.scan(docs_of(spark, [])).collect() == []


# --- op9 -------------------------------------------------------------------

@pytest.mark.parametrize("names", [["a", "b", None], ["é", "z", "Z", "", None, "a"], ["x"]])
def test_mix_targets_and_taken(spark, names):
    r = random.Random(len(names))
    pairs = [(i, " ".join("w" for _ in range(r.randint(0, 40)))) for i in range(400)] + [(7, "rep rep"), (7, "rep rep"), (None, "n n n"), (8, None)]
    pick = [names[min(int(r.expovariate(1.2)), len(names) - 1)] for _ in pairs]
    df = docs_of(spark, pairs, lambda k: pick[k])
    got = waterfill_mix.mix_copies(df).collect()
    assert len(got) == len(pairs)
    sizes = {}
    for (_, t), s in zip(pairs, pick, strict=True):
        sizes[s] = sizes.get(s, 0) + len(H.words(t))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = H.water_fill(sizes, {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)})
    taken, largest = {}, {}
    for x in got:
        assert x["source_size"] == sizes[x["source"]] and x["target"] == pytest.approx(want[x["source"]], rel=1e-12)
        assert 0 <= x["copies"] <= 3
        taken[x["source"]] = taken.get(x["source"], 0) + x["copies"] * x["size"]
        largest[x["source"]] = max(largest.get(x["source"], 0), x["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * largest[s] + 1
    again = waterfill_mix.mix_copies(df.repartition(5)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)
    rows = waterfill_mix.repeat_by_mix(df)
    assert rows.columns == df.columns
    assert rows.count() == sum(x["copies"] for x in got)


@pytest.mark.parametrize("total", [10**9, 2**31 - 1, 2**31, 10**13])
def test_mix_targets_of_many_words(spark, total):
    """Weight times words is above what an int holds, also where the words are not."""
    sizes = {"a": total // 100, "b": total // 5, "c": total - total // 100 - total // 5}
    weights = {"a": 1, "b": 2, "c": 3}
    df = spark.createDataFrame([(s, n, weights[s]) for s, n in sizes.items()], "source string, source_size long, weight int")
    want = H.water_fill(sizes, weights)
    for given in (None, total, float(total)):
        got = {x["source"]: x["target"] for x in waterfill_mix.fill_targets(df, total=given).collect()}
        assert got == pytest.approx(want, rel=1e-12)


def test_mix_empty_and_wordless(spark):
    assert waterfill_mix.mix_copies(docs_of(spark, [])).collect() == []
    got = waterfill_mix.mix_copies(docs_of(spark, [(1, None), (2, "")])).collect()
    assert [(x["size"], x["target"], x["copies"] * x["size"]) for x in got] == [(0, 0.0, 0)] * 2


# --- op5 -------------------------------------------------------------------

def test_simhash_fingerprints(spark):
    got = {(r[0], r[1]): r[2] for r in docs_of(spark, ODD[:4] + ODD[5:]).select(
        "doc_id", "text", simhash_tiles.fingerprint_column(F.col("text"))).collect()}
    for (_, t), fp in got.items():
        assert fp & (2**64 - 1) == H.simhash(t)


@pytest.mark.parametrize("tile,cell", [(4, 2), (4096, 2048), (30, 40)])
def test_simhash_components(spark, tile, cell):
    r = random.Random(tile)
    base = ["alpha beta gamma delta " * 30, "one two three four five six " * 25]
    pairs = list(ODD)
    for i in range(150):
        w = r.choice(base).split()
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = r.choice(["x", "y", "z"])
        pairs.append((1000 - i, " ".join(w)))
    got = simhash_tiles.dedup_classes(docs_of(spark, pairs), tile=tile, cell=cell).collect()
    assert len(got) == len(pairs)
    prints = sorted({x["fp"] & (2**64 - 1) for x in got})
    root = dict(zip(prints, H.components(prints), strict=True))
    least = {}
    for x in got:
        k = root[x["fp"] & (2**64 - 1)]
        if x["doc_id"] is not None:
            least[k] = min(least.get(k, x["doc_id"]), x["doc_id"])
    assert all(x["component_id"] == least.get(root[x["fp"] & (2**64 - 1)]) for x in got)


def test_simhash_chain_in_large_tiles(spark):
    """A chain of single-bit steps is one component, however it is tiled."""
    chain, x = [0], 0
    for k in range(40):
        x ^= 1 << (k * 3 % 20)
        chain.append(x)
    far = [(1 << 63) - 1 - (v << 21) for v in range(5)]
    prints = sorted(set(chain + far))
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = {r["node"]: r["root"] for r in simhash_tiles.components(simhash_tiles.links(df, 2, 3)).collect()}
    want = H.components(prints)
    assert [found.get(p, p) for p in prints] == [prints[w] for w in want]


def test_simhash_cells_fill_and_tiles_are_skipped(spark):
    """Random fingerprints and planted neighbours: every link is found whatever
    the width of the cells, and bit counts rule out tiles."""
    r = random.Random(12)
    prints = [r.getrandbits(64) for _ in range(3000)]
    prints += [p ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for p in prints[:300]]
    signed = sorted({p - 2**64 if p >= 2**63 else p for p in prints})
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    bits = np.array(signed, np.int64).view(np.uint64)
    a, b = np.nonzero(np.triu(np.bitwise_count(bits[:, None] ^ bits[None]) <= 2, 1))
    want = {(signed[x], signed[y]) for x, y in zip(a, b, strict=True)}
    assert [simhash_tiles.cell_bits(n, 2, 2048) for n in (0, 1, 2048, 2049, 9296, 10**12)] == [0, 0, 0, 1, 3, 21]
    for cell in (10, 500, 100_000):
        root = {x["node"]: x["root"] for x in simhash_tiles.components(simhash_tiles.links(df, cell=cell)).collect()}
        assert all(root.get(u, u) == root.get(v, v) for u, v in want)
        assert set(root) | set(root.values()) == {n for pair in want for n in pair}
    c = simhash_tiles.tile_counts(df, cell=1500).first()
    assert c["compared"] > 0 and c["skipped"] > c["compared"] * 0.3


# --- op6 -------------------------------------------------------------------

def test_top_k_equals_brute_force(spark):
    r = random.Random(6)
    vec = [(i, [r.choice([r.uniform(-1, 1), 0.5]) for _ in range(8)]) for i in range(260)]
    vec += [(50, vec[50][1]), (3, vec[3][1]), (400, None), (401, [1.0, None] + [0.0] * 6), (402, [float("nan")] * 8), (403, [float("inf")] * 8),
            (None, [0.9] * 8), (404, [0.25] * 3), (450, vec[0][1]), (500, [])]
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in vec], "vec_id long, embedding array<float>, label int, score string, rank int")
    vec32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vec]
    assert H.rows(pivot_topk.top_k(df.repartition(4))) == H.top_k(vec32)


@pytest.mark.parametrize("size", [1e6, 1e11, 1e16])
def test_top_k_of_large_components_is_exact(spark, size):
    """Beyond 2^53 in a product, beyond 2^63 in a score, and components at
    the limit of 64 bits."""
    r = random.Random(7)
    vec = [(i, [float(r.choice([-1, 1]) * r.uniform(0.5, 1) * size) for _ in range(6)]) for i in range(130)]
    vec += [(i, [v + d for v in vec[50][1]]) for i, d in ((200, 0.0), (201, 2 ** -8), (202, -(2 ** -8)))] + [(2**60 + 50, vec[3][1]), (None, vec[4][1])]
    got = pivot_topk.top_k(spark.createDataFrame(vec, "vec_id long, embedding array<double>").repartition(3), group_rows=40, query_block=2)
    clip = lambda n: max(-2**63, min(2**63 - 1, n))
    ints = [(i, [clip(int(np.floor(256 * x))) / 256 for x in v]) for i, v in vec] if size < 1e16 else vec
    assert H.rows(got) == sorted(((q, k, i, clip(s)) for q, k, i, s in H.top_k(ints)), key=repr)


def test_top_k_in_groups_and_blocks_eliminates(spark):
    """Groups and blocks change nothing; bounds leave most products unevaluated."""
    r = np.random.default_rng(8)
    v = [[int(x) for x in row] for row in np.floor(256 * r.normal(size=(1500, 64)) / 8)]
    df = spark.createDataFrame([(i, [x / 256 for x in row]) for i, row in enumerate(v)], "vec_id long, embedding array<float>")
    assert H.rows(pivot_topk.top_k(df.repartition(4), group_rows=100, query_block=7)) == H.rows(pivot_topk.top_k(df))
    basis = pivot_topk.choose_pivots(v[:1024])
    assert basis.shape == (48, 64) and np.allclose(basis @ basis.T, np.eye(48))
    x = np.array(v, float)
    c = x @ basis.T
    rest = np.sqrt(np.maximum((x ** 2).sum(1) - (c ** 2).sum(1), 0))
    table = {"id": np.arange(1500), "known": np.ones(1500, bool), "v": v, "c": list(c), "rest": rest, "norm": np.sqrt((x ** 2).sum(1))}
    at = np.arange(0, 1500, 50)
    asked = {n: [a[i] for i in at] if isinstance(a, list) else a[at] for n, a in table.items()}
    asked["floor"] = pivot_topk._floor(asked, np.arange(1024), np.array(v[:1024]), 5)
    found, evaluated = pivot_topk.search(table, asked, 5)
    assert len(found) == 5 * len(at) and evaluated < 0.4 * len(at) * 1500


def test_top_k_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert pivot_topk.top_k(spark.createDataFrame([], schema)).collect() == []
    few = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0])]
    assert H.rows(pivot_topk.top_k(spark.createDataFrame(few, schema))) == [(0, 1, 1, 65536), (0, 2, 2, 65536)]


# --- op7 -------------------------------------------------------------------

@pytest.mark.parametrize("pairs", [[], [(1, "the cat sat")], [(1, None), (2, ""), (None, "the dog of the house")],
                                   [(i * 7 % 101, f"the {i} of cat {i} and some {'the x ' * (i % 9)}") for i in range(101)], [(1, LONG), (2, "a 😀 the é")]])
def test_spotsigs_equal_brute_force(spark, pairs):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in pairs], "doc_id long, text string, h string, chunk int")
    assert H.rows(spotsigs.fingerprint_edits(df)) == H.spotsigs(pairs, spotsigs.signatures, spotsigs.to_string)


def test_spotsigs_null_and_repeated_ids(spark):
    pairs = [(None, f"null {i} the text") for i in range(30)] + [(5, "same the id"), (5, "same the id"), (5, "other the text")]
    got = spotsigs.fingerprint_edits(spark.createDataFrame(pairs, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] is None, r["n_chars"]) for r in got) == sorted((i is None, len(t)) for i, t in pairs)


@pytest.mark.parametrize("tile", [3, 2048])
def test_spotsigs_near_duplicates_equal_brute_force(spark, tile):
    r = random.Random(tile)
    vocab = [f"word{i}" for i in range(300)] + ["the", "of", "and", "in"] * 25
    base = [[r.choice(vocab) for _ in range(r.randint(20, 120))] for _ in range(12)]
    pairs = list(ODD)
    for i in range(120):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 1, 2, 8])):
            w[r.randrange(len(w))] = r.choice(vocab)
        pairs.append((1000 - i, " ".join(w + ["the", "same", "end", "of", "all"])))
    got = spotsigs.near_duplicates(docs_of(spark, pairs), tile=tile).collect()
    assert len(got) == len(pairs)
    sets = sorted({spotsigs.signatures(t or "") for _, t in pairs}, key=sorted)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if spotsigs.likeness(sets[a], sets[b]) >= 0.8:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    where = {x: find(k) for k, x in enumerate(sets)}
    least = {}
    for i, t in pairs:
        if i is not None:
            k = where[spotsigs.signatures(t or "")]
            least[k] = min(least.get(k, i), i)
    want = sorted(((i, len(spotsigs.signatures(t or "")), least.get(where[spotsigs.signatures(t or "")])) for i, t in pairs), key=repr)
    assert H.rows(spark.createDataFrame(got, "doc_id long, n_signatures int, class_id long")) == want
    assert spotsigs.near_duplicates(docs_of(spark, [])).collect() == []


def test_spotsigs_near_copies_of_31_and_32_words(spark):
    """Chains counted by hand: "start c0 c1", "the c0 c1", ..., "the c13 c14"
    and the cut "the c14"; a word appended lengthens the cut one only. So n
    pairs have n + 1 chains, and n of the n + 2 are shared."""
    texts = {n: " ".join(["start"] + [w for i in range(n) for w in ("the", f"c{n}x{i}")]) for n in range(5, 30)}
    assert len(texts[15].split()) == 31
    for n, t in texts.items():
        assert spotsigs.likeness(spotsigs.signatures(t), spotsigs.signatures(t + " end")) == pytest.approx(n / (n + 2))
    pairs = [p for n in (15, 20) for p in ((n, texts[n]), (n + 100, texts[n] + " end"))]
    got = {r["doc_id"]: r["class_id"] for r in spotsigs.near_duplicates(docs_of(spark, pairs)).collect()}
    assert got == {15: 15, 115: 15, 20: 20, 120: 20}


def test_spotsigs_likeness_bounds():
    r = random.Random(7)
    for _ in range(2000):
        a = frozenset(r.randrange(30) for _ in range(r.randrange(25)))
        b = frozenset(r.randrange(30) for _ in range(r.randrange(25)))
        full = spotsigs.likeness(a, b)
        assert full == (1.0 if not a and not b else len(a & b) / len(a | b))
        for floor in (0.2, 0.5, 0.8):
            got = spotsigs.likeness(a, b, floor)
            assert got == (full if full >= floor else 0.0) or (got == full and full < floor)


# --- op10 ------------------------------------------------------------------

MAGIC = warc_chain.MAGIC
FAKE = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
PAGES = [(1, "http://a/\r\nX: y", "abc"), (2, None, "abc"), (3, "u", None), (4, "u", ""), (5, "u", FAKE), (6, "u", "x" + FAKE * 3 + MAGIC),
         (7, "u", MAGIC * 4), (None, "n", "abc"), (None, "n", "zzz"), (8, "u", FAKE), (9, "é", "é" * 50 + MAGIC + "ü"), (1, "http://a", "abc"),
         (10, "u", "\r\n\r\n"), (11, "u", FAKE[:-4]), (12, "u", MAGIC + "Content-Length: 99999\r\n\r\n"), (13, "u", "x" * 200_000)]


@pytest.mark.parametrize("split", [None, "700", "5000"])
def test_warc_round_trip(spark, split):
    pages = PAGES + ([(100 + i, f"u{i}", "p" * (i % 37) + (FAKE if i % 5 == 0 else "")) for i in range(40)])
    if split:
        pages = [p for p in pages if p[0] != 13]
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, digest string, bytes string").coalesce(2)
        got = warc_chain.archive_and_read(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert H.rows(got) == H.warc(pages)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_warc_empty_and_minimum(spark):
    schema = "page_id long, url string, html string"
    assert warc_chain.archive_and_read(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "longer"), (4, "d", "longer")], schema)
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc_chain.archive_and_read(df, min_bytes=3).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


# --- op1 -------------------------------------------------------------------

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def judged(spark, urls, labels):
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, n int")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    return {r["page_id"]: r for r in url_reputation.judge(
        pages, known, rules=RULES, reference=F.regexp_extract("path", "^/[^/]*/([0-9]+)", 1).try_cast("long"), bad=1 - F.col("quality")).collect()}


def test_url_parts_and_rules(spark):
    urls = [None, "", "no scheme/path", "http://A.Example.NET/en/1?q#f", "https://x.net", "https://x.net/", "http://example.com/de/2#x",
            "ftp://WWW.B.org/fr/3", "http://a.org?x=http://b.net/", "http://fakeexample.com/de/", "x://h://p/q", "http://É.com/ÄB"]
    got = judged(spark, urls, [])
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(len(urls))] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a.example.net", "/en/1", "example.net/en/", "allow"),
        ("x.net", "", None, "allow"), ("x.net", "/", "net/", "block"), ("example.com", "/de/2", "example.com/de/", "block"),
        ("www.b.org", "/fr/3", "org/fr/", "allow"), ("a.org", "", None, "allow"), ("fakeexample.com", "/de/", None, "allow"),
        ("h:", "//p/q", None, "allow"), ("É.com", "/ÄB", None, "allow")]


def test_url_reputation_shrinks_and_blocks(spark):
    urls, labels, n = [], [], 0
    for host, good, bad in (("bad.spam.com", 5, 95), ("new.spam.com", 0, 0), ("fine.good.com", 98, 2), ("one.good.com", 0, 1), ("also.good.com", 60, 1)):
        for q in [1] * good + [0] * bad + ([None] if not good + bad else []):
            urls.append(f"http://{host}/en/{n}")
            if q is not None:
                labels.append((n, q))
            n += 1
    labels += [(None, 0), (3, None), (n + 5, 0)]
    got = judged(spark, urls, labels)
    by_host = {r["host"]: r for r in got.values()}
    assert by_host["bad.spam.com"]["verdict"] == "block"
    assert by_host["fine.good.com"]["verdict"] == by_host["one.good.com"]["verdict"] == "allow"      # one bad page is not enough
    assert by_host["new.spam.com"]["n"] == 0 and by_host["new.spam.com"]["bound"] > by_host["also.good.com"]["bound"]
    assert judged(spark, [], []) == {}


# --- op4 -------------------------------------------------------------------

def test_maximal_segments_equal_quadratic():
    def brute(s):
        """Ruzzo and Tompa's definition: split off the best segment, then both sides."""
        if not s:
            return []
        best = max(((sum(s[i:j]), -(j - i), -i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)))
        if best[0] <= 0:
            return []
        i, j = -best[2], best[3]
        return brute(s[:i]) + [(i, j, best[0])] + [(a + j, b + j, v) for a, b, v in brute(s[j:])]

    r = random.Random(1)
    for _ in range(400):
        s = [r.choice([-7, -3, -1, 2, 4, 5, 11]) + r.random() for _ in range(r.randint(0, 14))]
        got = toxic_segments.maximal_segments(s)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in brute(s)]


@pytest.fixture(scope="module")
def toxic_world(spark):
    r = random.Random(3)
    calm = [f"word{i}" for i in range(300)]
    rude = ["vileone", "viletwo", "nasty", "awful"]
    pairs, labels = [], []
    for i in range(600):
        w = [r.choice(calm) for _ in range(r.randint(5, 80))]
        y = int(i % 5 == 0)
        for _ in range(4 * y):
            w.insert(r.randrange(len(w) + 1), r.choice(rude))
        pairs.append((i, " ".join(w)))
        labels.append((i, 1, y))
    labels += [(None, 1, 1), (3, 1, None), (10_000, 1, 1), (5, 1, 1)]
    return pairs, labels


def test_toxicity_finds_passages(spark, toxic_world):
    pairs, labels = toxic_world
    df = docs_of(spark, pairs + ODD)
    rows = toxic_segments.training_rows(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    model = toxic_segments.fit(df, rows)
    got = df.select("doc_id", "text", toxic_segments.score(spark, F.col("text"), model).alias("s"),
                    toxic_segments.passages(spark, F.col("text"), model).alias("p")).collect()
    assert len(got) == len(pairs) + len(ODD)
    odd = {t for _, t in ODD}
    for x in got:
        assert 0 <= x["s"]["score"] <= 1
        rude = any(w in (x["text"] or "") for w in ("vile", "nasty", "awful"))
        if x["text"] not in odd:
            assert (x["s"]["score"] >= 0.3) == rude
        for p in x["p"]:
            assert any(w in x["text"][p["start"]:p["end"]] for w in ("vile", "nasty", "awful"))
        assert bool(x["p"]) == bool(x["s"]["n_passages"])


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1)]])
def test_toxicity_without_both_classes(spark, labels):
    df = docs_of(spark, ODD)
    model = toxic_segments.fit(df, toxic_segments.training_rows(spark.createDataFrame(labels, "doc_id long, toxic int")))
    scores = {x[0]["score"] for x in df.select(toxic_segments.score(spark, F.col("text"), model)).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() <= 1
    assert df.limit(0).select(toxic_segments.score(spark, F.col("text"), model)).collect() == []


# --- op2 -------------------------------------------------------------------

def quality_texts(n=300):
    r = random.Random(2)
    vocab = ["river", "stone", "green", "light", "morning", "letter", "window", "garden", "winter", "music"] + [f"word{i}" for i in range(200)]
    good, bad = [], []
    for i in range(n):
        s = ". ".join(" ".join(["The", *(r.choice([*vocab, "of", "the", "and"]) for _ in range(r.randint(6, 14)))]) for _ in range(r.randint(1, 8))) + "."
        good.append(s)
        if i % 5 == 0:
            bad.append(" ".join(w for w in s.split()[:12] for _ in range(20)))
        if i % 5 == 1:
            bad.append(" ".join(w.upper() + "!!" for w in s.split()))
        if i % 5 == 2:
            bad.append(" ".join(w + r.choice(["***", "%%%", "&&&"]) for w in s.split()))
    return good, bad


def test_quality_separates_and_keeps_short_clean_texts(spark):
    good, bad = quality_texts()
    pairs = [(i, t) for i, t in enumerate(good + bad)]
    df = docs_of(spark, pairs + [(None, good[0]), (5, good[5]), (9000, None), (9001, "")])
    model = weak_quality.fit(df)
    got = {x["doc_id"]: x["s"] for x in df.select("doc_id", weak_quality.score(spark, F.col("text"), model).alias("s")).collect()}
    kept = [got[i] >= weak_quality.KEEP_FROM for i in range(len(pairs))]
    assert np.mean(kept[:len(good)]) > 0.98
    assert np.mean(kept[len(good):]) < 0.05
    assert all(0 <= s <= 1 for s in got.values())


def test_quality_em_recovers_overlapping_labellers():
    """Votes drawn from known probabilities, each fault seen by three
    labellers: shares, accuracies and sides come back."""
    rng = np.random.default_rng(0)
    m = len(weak_quality.LABELLERS)
    counts, truth = {}, {}
    for _ in range(20_000):
        kind = rng.choice(m + 1, p=[0.8] + [0.2 / m] * m)
        p = np.full(m, 0.004)
        if kind:
            p[[kind - 1, kind % m, (kind + 1) % m]] = 0.95, 0.85, 0.8
        vote = np.where(rng.random(m) < 0.1, 1, np.where(rng.random(m) < p, 0, 2))
        code = 0
        for v in vote:
            code = code * 3 + int(v)
        counts[code] = counts.get(code, 0) + 1
        truth.setdefault(code, [0, 0])[int(kind == 0)] += 1
    model = weak_quality.estimate(counts)
    assert model.good == pytest.approx(0.8, abs=0.03)
    assert np.diag(model.accuracy[:, 1:]).min() > 0.8
    assert model.accuracy[:, 0].max() < 0.02
    right = sum(t[int(model.posterior[c] >= 0.5)] for c, t in truth.items())
    assert right > 0.98 * 20_000


def test_quality_of_one_side_and_no_rows(spark):
    for pairs in ([], [(1, None)], [(i, t) for i, t in enumerate(quality_texts(20)[0])]):
        df = docs_of(spark, pairs)
        model = weak_quality.fit(df)
        got = df.select(weak_quality.score(spark, F.col("text"), model).alias("s")).collect()
        assert len(got) == len(pairs) and all(0 <= x["s"] <= 1 for x in got)


# --- bounded samples, scripts, ports ----------------------------------------

def test_fits_take_one_row_of_a_hot_id(spark, monkeypatch):
    """An id that holds most rows reaches the driver once, and the model is
    that of the table without its repetitions."""
    r = random.Random(5)
    vocab = [f"word{i}" for i in range(200)] + ["the", "of", "and", "in"] * 20
    good = lambda: ". ".join("The " + " ".join(r.choice(vocab) for _ in range(9)) for _ in range(5)) + "."
    once = [(i, good() if i % 3 else " ".join(["bad"] * 40)) for i in range(60)]
    many = once + [once[1]] * 3000 + [once[3]] * 3000
    seen = []
    real = weak_quality.train
    monkeypatch.setattr(weak_quality, "train", lambda rows, good: seen.append(len(rows)) or real(rows, good))
    models = [weak_quality.fit(docs_of(spark, x), sample=10) for x in (once, many)]
    assert seen == [20, 20]
    assert (models[0].weights != 0).sum() == (models[1].weights != 0).sum()
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    rows = toxic_segments.training_rows(labels)
    a, b = (toxic_segments.fit(docs_of(spark, x), rows) for x in (once, many))
    assert a.scores == b.scores and a.weights == b.weights


def test_letters_of_other_scripts_are_letters():
    words = weak_quality.Words()
    names = weak_quality.LABELLERS
    for text in ("Это простое предложение о погоде, и в нём очень мало знаков, около 5 % шума, и больше ничего! " * 4,
                 "Αυτή είναι μια απλή πρόταση για τον καιρό, και έχει πολύ λίγα σημεία, 5 % θόρυβο, και τίποτε άλλο! " * 4):
        votes = dict(zip(names, weak_quality.votes(weak_quality.Document(text, words)), strict=True))
        assert votes["symbols"] != 0 and votes["function_words"] == 1
    assert dict(zip(names, weak_quality.votes(weak_quality.Document("zzz qqq xxx " * 10, words)), strict=True))["function_words"] == 0


def test_sites_without_ports_and_users(spark):
    hosts = ["a.example.com", "a.example.com:8080", "user:pw@a.example.com:1", "x.foo.co.uk:", "10.0.0.1:80", "[::1]:80", "localhost", "", "a@b@c.org"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string").select("h", url_reputation.site_of(F.col("h")).alias("s")).select(
        "h", url_reputation.suffix_of(F.col("s")).alias("suffix"), url_reputation.domain_of(F.col("s")).alias("domain"),
        url_reputation.domain_of(F.col("s"), ["example.com"]).alias("other"))
    got = {r["h"]: (r["suffix"], r["domain"]) for r in df.collect()}
    assert got == {"a.example.com": ("com", "example.com"), "a.example.com:8080": ("com", "example.com"),
                   "user:pw@a.example.com:1": ("com", "example.com"), "x.foo.co.uk:": ("co.uk", "foo.co.uk"), "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"),
                   "[::1]:80": ("[::1]", "[::1]"), "localhost": ("localhost", "localhost"), "": ("", ""), "a@b@c.org": ("org", "c.org")}
    assert df.filter("h = 'a.example.com:8080'").first()["other"] == "a.example.com"
