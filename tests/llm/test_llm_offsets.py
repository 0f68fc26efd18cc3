"""Op 4 tries evenly spread offsets and keeps the one whose words come nearest the target."""

import hashlib
import math

from pyspark.sql import functions as F

from martflow.llm import mixing


def test_the_best_of_the_tried_offsets_is_used(spark):
    rows = [(i, "w " * (1 + i * i % 23), "t") for i in range(61)]
    rows += [(100, "a b c d", "t")] * 7  # equal rows
    docs = spark.createDataFrame(rows + [(200 + i, "a b c", "s") for i in range(28)], "doc_id long, text string, source string")
    taken = mixing.sampled(docs, carry=False).select("row.doc_id", "size", "source_size", "target", "copies").collect()
    got = [r for r in taken if r.doc_id < 200]
    total, target = got[0].source_size, got[0].target
    assert len(taken) == 96 and len(got) == 68 and total == sum(r.size for r in got) and target == 1.5 * (total + 84) - 168
    # the order of the documents, and by hand the words that each offset takes
    def place(r):
        digest = hashlib.md5(f"{r[0]}:{r[1]}".encode()).hexdigest()
        bits = bin(len(r[1].split()))[2:]
        return len(bits), bits[:3], digest[:2], len(r[1].split()), r[0], digest
    sizes = [len(r[1].split()) for r in sorted(rows, key=place)]
    unit, rate = int(hashlib.md5(b"mix-1at").hexdigest()[:8], 16) / 2.0 ** 32, target / total
    def words(turn):
        return sum(n * (math.floor(turn + (k + 1) * rate) - math.floor(turn + k * rate)) for k, n in enumerate(sizes))
    turns = [(unit + j / 32) - math.floor(unit + j / 32) for j in range(32)]
    misses = [abs(words(t) - target) for t in turns]
    assert min(misses) < misses[0]  # the first offset alone is not the best
    assert abs(sum(r.size * r.copies for r in got) - target) == min(misses)
    whole = mixing.sampled(docs).filter("row.doc_id < 200").agg(F.sum(F.col("size") * F.col("copies"))).first()[0]
    assert abs(whole - target) == min(misses)
