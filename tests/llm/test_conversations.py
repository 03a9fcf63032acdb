"""The conversation trie against a plain nested dictionary."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from alignlake.llm import conversation_trie
from alignlake.registry.check import difference

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    members = {}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
        for d in range(len(paths[c]) + 1):
            members.setdefault(tuple(paths[c][:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        own_saved = (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        saved[node] = saved.get(node, 0) + own_saved
        leaves[node] = leaves.get(node, 0) or 1
        if node:
            up = node[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    return sorted((min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), children.get(node, 0), leaves[node], saved[node],
                   hashlib.sha256(",".join(str(c) for c in sorted(ms) if len(paths[c]) == len(node)).encode()).hexdigest())
                  for node, ms in members.items())


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


def conversations(seed, n=120):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(400), n):
        for t in range(rnd.choice([1, 1, 2, 3, 5])):
            rows.append((c, t, rnd.choice(["user", "user", None]), rnd.choice(["a b", "a  b\tc", "", None, "é x"])))
    return rows


ODD = [(None, 0, "user", "nobody"), (None, None, None, None), (20, None, "user", "first"), (20, 3, None, None), (20, 1, "user", "w " * 30_000),
       (25, 0, "", "x"), (25, 0, "", "x"), (801, 5, "user", "alone"), (1000, 0, "user", "only")]


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_equal_brute_force(spark, seed):
    rows = conversations(seed) + [r for r in ODD if r[0] not in {x[0] for x in conversations(seed)}]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"depth": F.lit("mine"), "a": F.lit(1), "pos": F.lit(2)})
    assert found(conversation_trie.prefix_trie(df.repartition(5))) == brute(rows)


def test_small_pieces_and_shards_give_the_same_nodes(spark, monkeypatch):
    rows = conversations(3) + [(1027, t, "user", f"t{t % 11}") for t in range(60)] + [(1207, t, "user", f"t{t % 11}") for t in range(50)]
    monkeypatch.setattr(conversation_trie, "PIECE", 4)
    monkeypatch.setattr(conversation_trie, "SHARD", 30)
    monkeypatch.setattr(conversation_trie, "BLOCK", 16)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(conversation_trie.prefix_trie(df)) == brute(rows)


def test_empty_tables_and_only_null_ids_have_no_nodes(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert found(conversation_trie.prefix_trie(spark.createDataFrame([], schema))) == []
    assert found(conversation_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], schema))) == []


def test_many_copies_share_one_path(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(300) for t in range(3)]
    assert found(conversation_trie.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))) == brute(rows)


def test_double_array_holds_what_was_put_in_and_nothing_else():
    rnd = np.random.default_rng(4)
    sizes = rnd.integers(0, 6, 400)
    codes = rnd.integers(0, 30, sizes.sum())
    roots = rnd.integers(0, 3, 400)
    trie = conversation_trie.packed(roots, codes, sizes)
    nodes = conversation_trie.walked(trie, roots, codes, sizes)
    ends, named, seen = np.cumsum(sizes), {}, {}
    for i, (end, size) in enumerate(zip(ends, sizes)):
        for d in range(size):
            key = (roots[i], *codes[end - size : end - size + d + 1])
            assert named.setdefault(key, nodes[end - size + d]) == nodes[end - size + d]
            assert seen.setdefault(nodes[end - size + d], key) == key
    absent = [k for k in {(r, c) for r in range(3) for c in range(40)} if k not in named]
    assert absent and (trie.step(np.array([k[0] for k in absent]), np.array([k[1] for k in absent])) == -1).all()


def test_query_matches_sql(spark, sf_dir):
    from alignlake.llm import corpus_queries

    assert difference(corpus_queries.QUERIES["op13_conversation_trie"](spark, sf_dir), sf_dir, corpus_queries.ORACLES["op13_conversation_trie"]) is None
