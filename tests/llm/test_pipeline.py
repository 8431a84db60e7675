"""Registered queries against their SQL, queries without SQL and the pipeline
against brute force, and their behaviour on odd tables."""

import base64
import datetime as dt
import hashlib
import os
import random

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from strata.llm import q_text, spotsigs, waterfill_mix
from strata.llm.queries import ORACLE_SQL, QUERIES
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    fix = lambda v: round(v, 9) if isinstance(v, float) else v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v
    return sorted(tuple(repr(fix(r[i])) for i in order) for r in rows)


def test_registered():
    ops = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert ops == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_dedup", "mix", "bpe"]


def sql_of(folder, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet{'' if os.path.isfile(f'{folder}/{t}.parquet') else '/*.parquet'}')")
    cur = con.execute(ORACLE_SQL[name])
    return canon([d[0] for d in cur.description], cur.fetchall())


@given
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == sql_of(SF, name)


# --- a small world with odd rows -------------------------------------------

def save(spark, folder, docs, labels, pages, vectors, conversations=()):
    for name, rows, schema in (
            ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
            ("labels", labels, "doc_id long, quality int, toxic int"),
            ("pages", pages, "page_id long, url string, html string"),
            ("embeddings", vectors, "vec_id long, embedding array<float>, label int"),
            ("conversations", list(conversations), "conv_id long, turn long, role string, text string")):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def world():
    r = random.Random(11)
    vocab = [f"word{i}" for i in range(400)] + ["of", "the", "and", "in"] * 30
    rude = ["vileone", "viletwo", "nastyone"]
    docs, labels, kind = [], [], {}
    for i in range(500):
        s = ". ".join(" ".join(["The", *(r.choice(vocab) for _ in range(r.randint(6, 14)))]) for _ in range(r.randint(2, 9))) + "."
        kind[i] = "clean"
        if i % 7 == 0:
            w = s.split()
            for _ in range(4):
                w.insert(r.randrange(len(w)), r.choice(rude))
            s, kind[i] = " ".join(w), "toxic"
        elif i % 11 == 0:
            s, kind[i] = " ".join(w for w in s.split()[:10] for _ in range(25)), "bad"
        elif i % 5 == 0 and i > 20:
            s, kind[i] = next(t for j, t, *_ in docs if kind[j] == "clean") + (" end" if i % 2 else ""), "copy"
        docs.append((i, s, "en", [None, "a", "b", "é"][min(int(r.expovariate(1)), 3)], len(s)))
        labels.append((i, int(kind[i] != "bad"), int(kind[i] == "toxic")))
    docs += [(1000, None, None, None, None), (1001, "", "en", "a", 0), (None, "The null id of a text and words in it.", None, "a", None),
             docs[1], docs[1], (None, None, None, None, None)]
    return docs, labels + [(None, 1, 1), (2000, None, None)], kind


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    docs, labels, kind = world()
    folder = save(spark, tmp_path_factory.mktemp("small"), docs, labels,
                  [(i, f"http://h{i % 5}.example.net/en/{i}", "x" * (i % 4)) for i in range(30)] + [(None, None, None)],
                  [(i, [0.1 * i, 0.5], 1) for i in range(60)] + [(None, None, None)])
    return folder, docs, kind


@pytest.fixture(scope="module")
def tik():
    path = public_tokenizers.path(q_text.RANKS)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digests(tik, i, t):
    ids = tik.encode_ordinary(t or "")
    return (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql_on_odd_rows(spark, small, name):
    df = QUERIES[name](spark, small[0])
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    want = sql_of(small[0], name)
    if name == "op9_source_mix":            # rows that repeat an id are taken alike; SQL counts them one by one
        at = sorted(df.columns).index("doc_id")
        got, want = ([r for r in rows if r[at] != "1"] for rows in (got, want))
    assert got == want


@pytest.mark.parametrize("texts", [lambda r, i: "alike in every row", lambda r, i: " ".join(["w"] * r.randint(1, 3) + [str(i)])])
def test_op9_cuts_inside_repeated_ids(spark, tmp_path, texts):
    """Every id (and null id and text) has many rows, so that each source's
    prefix ends among rows of one id; SQL counts them one by one."""
    r = random.Random(9)
    docs = [(k, texts(r, i), "en", s, 0) for s, n in (("a", 60), ("b", 150), (None, 90)) for k in (5, 6) for i in range(n)]
    docs += [(None, "n n n", "en", "a", 0)] * 40
    folder = save(spark, tmp_path, docs, [(0, 1, 0)], [(0, "", "")], [(0, [0.1], 1)])
    df = QUERIES["op9_source_mix"](spark, folder)
    got = [tuple(r) for r in df.collect()]
    assert canon(df.columns, got) == sql_of(folder, "op9_source_mix")
    table = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sorted(map(tuple, corpus_pipeline.mix(spark, table, folder).collect()), key=repr)
    at = {c: df.columns.index(c) for c in df.columns}
    for i in (5, 6, None):
        assert sum(d[0] == i for d in rows) == sum(g[at["copies"]] for g in got if g[at["doc_id"]] == i)
        assert sum(len(H.words(d[1])) for d in rows if d[0] == i) == sum(g[at["taken"]] for g in got if g[at["doc_id"]] == i)
    assert rows == sorted(map(tuple, corpus_pipeline.mix(spark, table.repartition(7), folder).collect()), key=repr)


@pytest.fixture
def many_words(spark, tmp_path, monkeypatch):
    """Documents of three even sources, and a function after which each of
    their words counts as 2 ** k words, over 2 ** 30 in all."""
    r = random.Random(12)
    docs = [(i, " ".join(["w"] * r.randint(1, 30)), "en", "abc"[i % 3], 0) for i in range(300)]
    n = sum(len(H.words(d[1])) for d in docs)
    times = 1 << ((2**31 - 1) // n).bit_length() - 1
    assert 2**30 < n * times < 2**31
    words = waterfill_mix.words

    def grow():
        monkeypatch.setattr(waterfill_mix, "words", lambda text: words(text) * F.lit(times).cast("long"))
        return times
    return save(spark, tmp_path, docs, [(0, 1, 0)], [(0, "", "")], [(0, [0.1], 1)]), grow


def test_pipeline_mix_of_many_words(spark, many_words):
    folder, grow = many_words
    table = spark.read.parquet(f"{folder}/documents.parquet")
    mixed = lambda: sorted(map(tuple, corpus_pipeline.mix(spark, table, folder).collect()))
    want = mixed()
    grow()
    assert mixed() == want and len(want) > 0


def test_op9_of_many_words(spark, many_words):
    folder, grow = many_words
    mixed = lambda: sorted(map(tuple, QUERIES["op9_source_mix"](spark, folder).collect()))
    want, times = mixed(), grow()
    assert mixed() == [(i, size * times, source_size * times, target * times, taken * times, copies)
                       for i, size, source_size, target, taken, copies in want]


def test_op9_equals_sql_on_all_odd_rows(spark, small):
    df = QUERIES["op9_source_mix"](spark, small[0])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == sql_of(small[0], "op9_source_mix")


def test_op3_equals_tiktoken(spark, small, tik):
    folder, docs, _ = small
    assert H.rows(QUERIES["op3_bpe_round_trip"](spark, folder)) == sorted((digests(tik, d[0], d[1]) for d in docs), key=repr)


def test_op5_equals_brute_force(spark, small):
    folder, docs, _ = small
    prints = [H.simhash(d[1]) for d in docs]
    distinct = sorted(set(prints))
    root = dict(zip(distinct, H.components(distinct), strict=True))
    least = {}
    for d, p in zip(docs, prints, strict=True):
        if d[0] is not None:
            least[root[p]] = min(least.get(root[p], d[0]), d[0])
    want = sorted(((d[0], f"{p:016x}", least.get(root[p])) for d, p in zip(docs, prints, strict=True)), key=repr)
    assert H.rows(QUERIES["op5_simhash_dedup"](spark, folder)) == want


def test_op7_equals_brute_force(spark, small):
    folder, docs, _ = small
    once = {d[0]: d[1] for d in docs if d[0] is not None}
    nulls = [(None, t) for i, t, *_ in docs if i is None]
    got = [r for r in H.rows(QUERIES["op7_spotsigs"](spark, folder)) if r[0] not in (None, 0, 1, 2)]
    want = H.spotsigs(list(once.items()) + nulls, spotsigs.signatures, spotsigs.to_string)
    assert got == [r for r in want if r[0] not in (None, 0, 1, 2)]      # beside repeated and null ids order is by hash


def test_op10_equals_brute_force(spark, small):
    got = QUERIES["op10_warc_archive"](spark, small[0]).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    pages = [(i, "", "x" * (i % 4)) for i in range(30)] + [(None, None, None)]
    assert H.rows(got) == H.warc(pages)


def test_op4_and_op2_on_planted_documents(spark, small):
    folder, docs, kind = small
    toxic = {r["doc_id"]: r for r in QUERIES["op4_toxicity"](spark, folder).collect()}
    kept = {r["doc_id"]: r["kept"] for r in QUERIES["op2_weak_quality"](spark, folder).collect()}
    for i, k in kind.items():
        assert toxic[i]["predicted"] == int(k == "toxic") == int(toxic[i]["score"] >= 0.3)
        assert kept[i] == int(k != "bad")


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="given tables not present")
def test_held_out_accuracy_on_given_labels(spark):
    """Labels of the held-out fold, which the fit never reads, are ranked
    well; the quality scorer reads no labels at all."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = QUERIES["op4_toxicity"](spark, folder).filter("held_out").join(labels, "doc_id").toPandas()
    rank, toxic = got["score"].rank(), got["toxic"] == 1
    auc = (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.95
    kept = QUERIES["op2_weak_quality"](spark, folder).join(labels, "doc_id").toPandas()
    assert (kept["kept"] == kept["quality"]).mean() > 0.98


# --- the pipeline ----------------------------------------------------------

def mix_brute(docs, seed="mix"):
    """Copies by (id, text) from whole sorted lists."""
    sizes, rows = {}, {}
    for i, t, _, s, _ in docs:
        sizes[s] = sizes.get(s, 0) + len(H.words(t))
        key = str(i) if i is not None else "null:" + hashlib.md5((t or "").encode()).hexdigest()
        rows.setdefault(s, []).append((int(hashlib.md5(f"{key}|{seed}".encode()).hexdigest()[:15], 16), i if i is not None else -1, len(H.words(t)), (i, t)))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = H.water_fill(sizes, {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)})
    out = []
    for s, members in rows.items():
        whole = int(target[s] // sizes[s]) if sizes[s] else 0
        extra, upto = target[s] - whole * sizes[s], 0
        for _, _, n, row in sorted(members, key=lambda m: m[:3]):
            upto += n
            out += [row] * (whole + int(extra > 0 and upto - n / 2 <= extra))
    return out


def test_pipeline_equals_brute_force(spark, small, tik, tmp_path):
    folder, docs, kind = small
    df, left = spark.read.parquet(f"{folder}/documents.parquet"), docs
    columns = df.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        df = stage(spark, df, folder)
        df.write.parquet(f"{tmp_path}/{k}")
        df = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "toxicity":
            left = [d for d in left if kind.get(d[0]) != "toxic"]
        elif name == "quality":
            left = [d for d in left if kind.get(d[0]) != "bad"]
        elif name == "near_dedup":
            prints = sorted({H.simhash(d[1]) for d in left})
            root = dict(zip(prints, H.components(prints), strict=True))
            first = {}
            for d in sorted(left, key=lambda d: (d[0] is None, d[0] or 0)):
                first.setdefault(root[H.simhash(d[1])], d)
            left = list(first.values())
        elif name == "mix":
            assert df.columns == columns
            left = mix_brute(left)
            assert sorted(map(tuple, df.select("doc_id", "text").collect()), key=repr) == sorted(left, key=repr)
            continue
        else:
            assert H.rows(df) == sorted((digests(tik, i, t) for i, t in left), key=repr)
            continue
        assert df.columns == columns
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(left, key=repr)
    assert H.rows(corpus_pipeline.run(spark, folder)) == H.rows(df)


def test_stages_keep_clashing_columns_and_empty_tables(spark, small):
    folder, docs, _ = small
    base = spark.createDataFrame(docs[:60], "doc_id long, text string, lang string, source string, n_chars long")
    odd = base.withColumns({n: F.lit(n) for n in ("row", "u", "stage_toxicity", "stage_quality", "score", "own_id", "size", "whole", "fp", "again")})
    for _, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, odd, folder)
        assert got.columns == odd.columns
        assert {r["row"] for r in got.collect()} <= {"row"}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, base.limit(0), folder).collect() == []


def test_queries_on_empty_tables(spark, tmp_path):
    folder = save(spark, tmp_path, [], [], [], [])
    for name, query in QUERIES.items():
        assert query(spark, folder).collect() == [], name
