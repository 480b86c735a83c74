"""What a Python worker holds while it encodes texts."""

import tracemalloc

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from mlframe.llm import common, tokens


def words(n):
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 12, n)
    sizes[n // 2] = 300  # a word beyond the table of weights
    starts = np.cumsum(sizes) - sizes
    return rng.integers(97, 100, int(sizes.sum()), np.uint8), starts, sizes


def test_blocks_change_no_hash(monkeypatch):
    codes, starts, sizes = words(5000)
    seen = []
    for size in (1, 7, 1000, 1 << 40):
        monkeypatch.setattr(common, "RUN_BYTES", size)
        which, of = common.distinct_runs(codes, starts, sizes)
        assert common.equal_runs(codes, starts, codes, starts[which[of]], sizes).all()
        seen.append((common.run_hashes(codes, starts, sizes).tolist(), which.tolist(), of.tolist()))
    assert seen.count(seen[0]) == len(seen)
    other = codes.copy()
    other[starts[77]] ^= 1
    monkeypatch.setattr(common, "RUN_BYTES", 50)
    assert np.flatnonzero(~common.equal_runs(codes, starts, other, starts, sizes)).tolist() == [77]
    none = np.zeros(0, np.int64)
    assert len(common.run_hashes(codes, none, none)) == len(common.equal_runs(codes, none, codes, none, none)) == 0


def test_hashing_takes_little_room():
    codes, starts, sizes = words(500_000)  # 3 MB of letters
    for f in (lambda: common.run_hashes(codes, starts, sizes), lambda: common.equal_runs(codes, starts, codes, starts, sizes)):
        tracemalloc.start()
        f()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 40e6


def test_batches_of_the_encoder_are_bounded(spark, tmp_path, monkeypatch):
    def sizes(shared):
        def run(batches):
            import pyarrow as pa

            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([str(b.num_rows).encode()], pa.binary())], ["shard"])
        return run

    monkeypatch.setattr(tokens, "_write", sizes)
    before = spark.conf.get(tokens.BATCH)
    tokens.write(spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text")), str(tmp_path / "t"), public_tokenizers.path("word_bpe_49k.json"))
    rows = [int(r.value) for r in spark.read.text(str(tmp_path / "t")).collect()]
    assert sum(rows) == 5000 and max(rows) <= tokens.BATCH_ROWS
    assert spark.conf.get(tokens.BATCH) == before
