"""The law, the slots and the links of small corpora; groups that fit are whole."""

import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm.brute import EDGE, docs_of, prose
from txnflow.llm import sharding as H
from txnflow.llm.queries import QUERIES


def laws(rows, got, shards):
    """What must hold of (doc_id, size, text_crc32, shard, slot) whatever the moves were."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    want = Counter((i, len(b) + 8, zlib.crc32(b)) for i, b in raw)
    assert Counter(r[:3] for r in got) == want
    slots = defaultdict(list)
    for *_, shard, slot in got:
        assert 0 <= shard < shards
        slots[shard].append(slot)
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def split(got):
    """Documents outside the shard with most of their group."""
    groups = defaultdict(Counter)
    for _, size, crc, shard, _ in got:
        groups[size, crc][shard] += 1
    return sum(sum(c.values()) - max(c.values()) for c in groups.values())


def run(spark, rows, shards):
    placed = H.assign_shards(docs_of(spark, rows), shards)
    got = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in placed.collect()]
    laws(rows, got, shards)
    assert tuple(H.cut_documents(placed).first())[1] == split(got)
    return got


def test_groups_that_fit_are_whole(spark):
    rows = [(i, prose(20, i)) for i in range(300)]
    for g, size in enumerate([2, 2, 3, 5, 8, 13, 21, 34, 2, 2]):
        rows += [(1000 * (g + 1) + j, prose(30, 9000 + g)) for j in range(size)]
    assert split(run(spark, rows, 8)) == 0


def test_a_group_above_a_shard_is_split_as_little_as_possible(spark):
    rows = [(i, "hot") for i in range(200)] + [(1000 + i, prose(9, i)) for i in range(400)]
    got = run(spark, rows, 6)
    shards = Counter(r[3] for r in got if r[1] == 3 + 8)
    assert len(shards) <= 3 and max(shards.values()) >= 90


def test_only_links_and_tight_quotas(spark):
    rows = [(100 * g + j, f"text {g}") for g in range(40) for j in range(5)]
    got = run(spark, rows, 8)
    assert split(got) <= 60  # of 200, every shard full to the last row


def test_edge_rows(spark):
    run(spark, EDGE, 4)
    run(spark, EDGE + [(None, None)] * 9 + [(7, "same row")] * 11, 3)
    run(spark, [(1, "few")], 24)
    assert H.assign_shards(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query(spark, sf):
    got = QUERIES["op11_sharding"](spark, sf)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    laws(rows, [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got.collect()], 24)
