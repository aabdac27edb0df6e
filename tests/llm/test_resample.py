"""Importance resampling against a plain version: zlib's CRC-32, Python's regular expressions and sorted()."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sparkassay.llm import resample
from sparkassay.llm.queries import op12_importance_resampling
from tests.llm.conftest import TEXTS, prose

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(resample.WORD, (text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain_version(docs, target, percent=10, buckets=10_000, min_words=20):
    """(doc_id, n_features, weight, score, rank) by the definition, one document at a time."""
    bucket = lambda w: zlib.crc32(w.encode()) % buckets
    s = collections.Counter(bucket(w) for _, t in docs for w in words(t))
    t = collections.Counter(bucket(w) for x in target for w in words(x))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    rows = []
    for doc_id, text in docs:
        w = words(text)
        weight = sum(gain(bucket(x)) for x in w)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(w), weight, score, None])
    eligible = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(eligible[: percent * len(eligible) // 100]):
        r[4] = i + 1
    return rows


def canon(rows):
    return sorted(tuple(-1 if x is None else x for x in r) for r in rows)


def test_position_table_crc_equals_zlib():
    rng = random.Random(7)
    spans = [bytes(rng.randrange(256) for _ in range(rng.choice([1, 3, 63, 64, 65, 128, 129, 1000, 9000]))) for _ in range(300)]
    data = np.frombuffer(b"".join(spans), np.uint8)
    lengths = np.array([len(x) for x in spans])
    got = resample.span_crc32(data, np.cumsum(lengths) - lengths, lengths)
    assert [int(g) for g in got] == [zlib.crc32(x) for x in spans]
    assert len(resample.span_crc32(data, lengths[:0], lengths[:0])) == 0


def test_features_follow_the_word_pattern():
    texts = ["Hello WORLD, héllo 123abc ÉCOLE_x y", None, "", "!!!", "a" * 70_000 + " Zz"]
    feats, owner = resample.features(pa.array(texts))
    assert feats.to_pylist() == [w for t in texts for w in words(t)]
    assert owner.tolist() == [i for i, t in enumerate(texts) for _ in words(t)]


def test_operator_equals_plain_version(spark, docs):
    target = [prose(50, 300), TEXTS[4], None, ""]
    tdf = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for percent in (10, 50, 100):
        got = resample.importance_resample(docs, tdf, percent=percent)
        assert set(got.columns) >= {"doc_id", "text", "id", "size", "score", "n_features", "weight", "rank"}
        got = got.select("doc_id", "n_features", "weight", "score", "rank").collect()
        assert canon(got) == canon(plain_version(rows, target, percent))
    assert resample.importance_resample(docs.limit(0), tdf).count() == 0


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the given tables")
def test_query_equals_plain_version_on_given_tables(spark):
    import pyarrow.parquet as pq

    docs = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    target = pq.read_table(f"{SF}/benchmark.parquet", columns=["text"]).column("text").to_pylist()
    got = op12_importance_resampling(spark, SF).collect()
    wanted = plain_version([(r["doc_id"], r["text"]) for r in docs], target)
    assert canon(got) == canon(wanted)
    assert sum(r["rank"] is not None for r in got) == 10 * sum(r[1] >= 20 for r in wanted) // 100 > 0
