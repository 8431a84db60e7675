"""Prefix trie and structure repair against brute force, on small tables
with nulls, ties, repeated rows, grafts, hot first turns and long rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import prefix_trie, structure_repair
from strata.llm.q_conversations import damaged, op12_prefix_trie, op13_structure_repair
from tests.llm import helpers as H

ROWS = "conv_id long, turn long, role string, text string, depth long, a long, skip int, fault int, present boolean, digest string, top string"
TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
REPAIR = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def save(spark, folder, rows):
    wide = [(*r, 7, 8, 9, 1, False, "d", "t") for r in rows]
    spark.createDataFrame(wide, ROWS).repartition(3).write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def world(seed=3):
    r = random.Random(seed)
    texts = ["Hi.", "No", "What?", "", None, "  \t\n", "Yes! ", "é 中文 😀.", "a.b", "."]
    rows = []
    for c in [*range(0, 40), 100, 101, 105, 117, 199, 250, 251, -1, -5, -100, -101, -177, 2**53 + 1, 2**62 + 7]:
        for t in range(r.randint(1, 9)):
            rows.append((c, r.choice([t, t, t, t + 2, None]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), r.choice(texts)))
    for c in range(300, 340):                       # copies, and a first turn that many share
        rows += [(c, 0, "system", "Be brief."), (c, 1, "user", "Q?" if c % 3 else f"Q{c}?"), (c, 2, "assistant", "A.")][:r.randint(1, 3)]
    rows += [rows[0], rows[0], rows[5]]             # repeated rows
    rows += [(None, 0, "user", "null id."), (None, 1, "assistant", "null id."), (None, None, None, None)]
    rows += [(400, t, "user" if t % 2 else "assistant", f"long {t}" + "." * (t % 3)) for t in range(150)]
    return rows


# --- op12 ------------------------------------------------------------------

def test_trie_equals_brute_force(spark, tmp_path):
    rows = world()
    folder = save(spark, tmp_path, rows)
    want = H.trie(H.rebuilt(rows))
    assert H.rows(op12_prefix_trie(spark, folder).select(*TRIE)) == want


@pytest.mark.parametrize("fan,shard", [(2, 1), (3, 5), (2, 100_000)])
def test_trie_over_many_classes_and_shards(spark, fan, shard):
    rows = [(c, t, "user", x) for c in range(60) for t, x in enumerate(f"{c:06b}"[:1 + c % 6])]
    rebuilt = prefix_trie.turns(spark.createDataFrame([(*r, 7, 8, 9, 1, False, "d", "t") for r in rows], ROWS)).withColumn("skip", F.lit(0))
    convs = {c: [(r, x) for _, r, x in v] for c, v in H.by_turn(rows).items()}
    assert H.rows(prefix_trie.trie(rebuilt, fan=fan, shard_nodes=shard).select(*TRIE)) == H.trie(convs)


def test_trie_of_nothing_and_of_turnless_conversations(spark, tmp_path):
    assert op12_prefix_trie(spark, save(spark, tmp_path / "a", [])).collect() == []
    rows = [(c, 0, "user", "x") for c in range(1, 100)]     # source 0 doesn't exist: most lose their only turn
    got = op12_prefix_trie(spark, save(spark, tmp_path / "b", rows)).select(*TRIE)
    assert H.rows(got) == H.trie(H.rebuilt(rows))
    only = [(1, 0, "user", "x")]
    got = H.rows(op12_prefix_trie(spark, save(spark, tmp_path / "c", only)).select(*TRIE))
    assert got == H.trie(H.rebuilt(only)) and len(got) == 1


def test_runs_of_ids_across_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN_IDS", 7)
    links = spark.createDataFrame([(c, 1, c % 2, -5, 0, 0, 1, c % 9 != 0) for c in range(-50, 400)], prefix_trie.LINK).repartition(5)
    import hashlib
    want = [(a, -5, hashlib.sha256(",".join(str(c) for c in range(-50, 400) if c % 2 == a and c % 9).encode()).hexdigest()) for a in (0, 1)]
    assert H.rows(prefix_trie.ends(links)) == want


def test_node_table_is_minimal_and_verifies():
    r = np.random.default_rng(5)
    for n in (0, 1, 2, 37, 5000):
        a, b = r.integers(-2**63, 2**63 - 1, (2, n))
        if n > 2:
            a[:n // 2], b[n // 2:] = a[0], b[-1]          # halves that repeat
            b[:n // 2] = np.arange(n // 2)
            a[n // 2:] = np.arange(n - n // 2)
        table = prefix_trie.NodeTable(a, b)
        assert sorted(table.find(a, b)) == list(range(n)) and (table.find(a, b) == table.slots).all()
        assert (table.find(a, b + 10**6) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.NodeTable(np.array([1, 1]), np.array([2, 2]))


# --- op13 ------------------------------------------------------------------

def test_repair_equals_brute_force(spark, tmp_path):
    rows = world() + [r for s in range(4, 9) for r in ((c + 1000 * s if c is not None else None, *x) for c, *x in world(s)) if r[0] is not None and r[0] < 2**53]
    got = {r["conv_id"]: tuple(r[c] for c in REPAIR) for r in op13_structure_repair(spark, save(spark, tmp_path, rows)).collect()}
    want = H.damaged(rows)
    assert set(got) == set(want)
    for c, v in want.items():
        assert got[c] == H.repaired(v), (c, v)


@pytest.mark.parametrize("chunk", [1, 2, 5])
def test_repair_in_chunks_equals_whole(spark, chunk):
    df = damaged(spark.createDataFrame([(*r, 7, 8, 9, 1, False, "d", "t") for r in world(9)], ROWS).select("conv_id", "turn", "role", "text"))
    assert H.rows(structure_repair.repair(df, present=F.col("present"), chunk=chunk)) == H.rows(structure_repair.repair(df, present=F.col("present")))


def test_search_finds_the_ascii_least_of_the_cheapest():
    """Against all edit strings of up to 7 letters over short symbol strings."""
    r = random.Random(2)
    for symbols in {"".join(r.choice("suaxSUAX#") for _ in range(r.randint(0, 3))) for _ in range(120)}:
        best = None
        for n in range(len(symbols) + 5):
            for edits in itertools.product("DIKR", repeat=n):
                i = state = cost = 0
                for e in edits:
                    nxt = next((x for x in structure_repair._edits(symbols, i, state) if x[0] == e), None)
                    if nxt is None:
                        break
                    _, i, state, c = nxt
                    cost += c
                else:
                    if i == len(symbols) and state in (0, 3) and (best is None or (cost, "".join(edits)) < best):
                        best = (cost, "".join(edits))
        assert structure_repair.search(symbols, 0, (0, 3)) == best, symbols


def test_repair_by_hand_and_empty(spark, tmp_path):
    def one(*rows):
        df = spark.createDataFrame([(1, k, r, x) for k, (r, x) in enumerate(rows)], "conv_id long, turn long, role string, text string")
        return tuple(structure_repair.repair(df).select("illegal", "cost", "audit").first())
    assert one(("system", "S."), ("user", "Q?"), ("assistant", "A.")) == (0, 0, "KKK")
    assert one(("user", "Q?"), ("user", "P?"), ("assistant", "A.")) == (1, 2, "KIKK")
    assert one(("user", "Q?")) == (0, 2, "KI")
    assert one(("system", "S.")) == (0, 3, "D")
    assert one(("tool", "T"), ("assistant", "A.")) == (1, 3, "RK")
    assert op13_structure_repair(spark, save(spark, tmp_path, [])).collect() == []


def test_long_conversation_with_many_faults(spark):
    r = random.Random(1)
    rows = [(1, t, r.choice(["user", "assistant", "system", "tool"]), r.choice(["x.", "y", "", f"z{t}.", f"q{t}"])) for t in range(3_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = structure_repair.repair(df).first()
    assert tuple(got[c] for c in REPAIR) == H.repaired([(t, a, b) for _, t, a, b in rows])
