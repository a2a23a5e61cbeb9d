import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from pricetide.llm.sharding import feistel, permuted, shard_documents

from .frames import awkward, docs


def h(*values):
    """Spark's xxhash64 of longs."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def plain_place(x, n, seed, rounds=6):
    a = 1
    while a * a < n:
        a += 1
    b = -(-n // a)
    while True:
        left, right = divmod(x, b)
        for k in range(rounds):
            key = seed * 1000 + k
            if k % 2 == 0:
                left = (left + h(key, right) % a) % a
            else:
                right = (right + h(key, left) % b) % b
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 50, 101, 1000])
def test_permutation(sp, n):
    got = [r[0] for r in sp.range(n).orderBy("id").select(permuted(F.col("id"), n, 17)).collect()]
    assert sorted(got) == list(range(n))
    assert got == [plain_place(x, n, 17) for x in range(n)]


def test_one_pass_is_a_bijection(sp):
    assert sp.range(35).select(feistel(F.col("id"), 7, 5, 3).alias("p")).distinct().count() == 35


def test_shards(sp):
    rows = awkward() + [(10, "same")] * 200 + [(i, f"t{i}") for i in range(20, 400)]
    out = shard_documents(docs(sp, rows, extra=("shard", "row_no")).repartition(7)).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert (r["shard"], r["slot"]) == (plain_place(r["row_no"], len(rows), 17) % 16, plain_place(r["row_no"], len(rows), 17) // 16)
    assert sorted(by) == list(range(16))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    key = lambda i, s, c: (i is not None, i or 0, s, c)
    want = sorted(key(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert want == sorted(key(r["doc_id"], r["size"], r["text_crc32"]) for r in out)
    again = shard_documents(docs(sp, rows).repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_no_python_and_empty(sp):
    df = shard_documents(docs(sp, [(1, "a"), (2, "b")]))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
    assert shard_documents(docs(sp, [])).count() == 0


def test_rows_without_an_id_share_no_bucket(sp):
    out = shard_documents(docs(sp, [(None, "x" * i) for i in range(500)])).orderBy("row_no").collect()
    assert [r["row_no"] for r in out] == list(range(500))
    assert [r["size"] for r in out] != sorted(r["size"] for r in out)      # a single bucket is ordered by its keys
