"""Operators on documents against plain versions, on a table with every odd case."""

import collections
import hashlib
import re
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkassay.llm import chaining, mixing, packing, personal, records, toxicity, weighted_minhash
from sparkassay.llm.shingles import MIX_A, bucket, inverse_frequencies, mix, shingle_hashes
from sparkassay.llm.tokens import Encoder, default_vocabulary
from sparkassay.session import drop_written, scratch_path, shared_dir
from tests.llm.conftest import BASE, TEXTS, prose

ROWS = len(TEXTS) + 2


def ids_of(text, end):
    tokenizer = Tokenizer.from_file(default_vocabulary())
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def test_packing_is_whole_gapless_and_tight(docs):
    rows = packing.best_fit_sequences(docs).collect()
    source = collections.Counter((r["doc_id"], tuple(ids_of(r["text"], 2))) for r in docs.collect())
    parts = collections.defaultdict(list)
    for r in rows:
        parts[r["sequence_id"]].append((r["offset"], len(r["ids"]) // 4))
    for own in parts.values():
        assert [at for at, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= 1024
    every = [tuple(ids_of(r["text"], 2)) for r in docs.collect()]
    assert sum(len(r["ids"]) // 4 for r in rows) == sum(map(len, every))
    long = max(every, key=len)
    own = sorted((r["piece"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in rows if r["doc_id"] == 9)
    assert tuple(x for _, _, ids in own for x in ids) == long and all(len(ids) == 1024 for _, _, ids in own[1:])
    assert collections.Counter(r["doc_id"] for r in rows if r["piece"] == 0) == collections.Counter(i for i, _ in source.elements())


def test_packing_holds_every_capacity(docs):
    rows = packing.best_fit_sequences(docs, documents=2, attention=1024.0**2).collect()
    bins = collections.Counter(r["sequence_id"] for r in rows)
    assert max(bins.values()) <= 2
    with pytest.raises(ValueError):
        packing.best_fit_sequences(docs, attention=10.0)


def test_words_are_encoded_once_whatever_follows_them():
    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer, self.seen = tokenizer, collections.Counter()

        def encode_batch_fast(self, texts, **options):
            self.seen.update(word for text in texts for word in re.findall("[a-z]+", text))
            return self.tokenizer.encode_batch_fast(texts, **options)

    encoder = Encoder(default_vocabulary())
    counting = encoder.tokenizer = Counting(encoder.tokenizer)
    encoder.encode(["First " + " ".join(f"word{end} other" for end in (".", ",", "!", "\n", "'s", "-", "_", "?!", ""))])
    assert counting.seen["word"] == counting.seen["other"] == 1


def test_ids_of_pieces_equal_whole_texts():
    letters = ["a", "Bc", "é", "ɏ", "ɐ", "ª", "²", "Ω", "中", "5", "'s", "'", ".", "\n", "\t", "\x1c", "_", "×", "<|endoftext|>", " "]
    texts = [" ".join(a + b + c for c in letters) for a in letters for b in letters]
    for remembered in (10**6, 3):
        encoder = Encoder(default_vocabulary(), remembered)
        for _ in range(2):
            assert encoder.encode(texts) == encoder.whole(texts)
        each = [f"{a}{b} {c}{d}" for a, b, c, d in zip(letters * 19, letters[3:] * 23, letters[5:] * 25, letters[7:] * 29)]
        assert encoder.encode(each) == encoder.whole(each)


def test_records_round_trip(spark, docs):
    folder = scratch_path(spark, "records")
    shards = records.write_records(docs, folder)
    rows = records.read_records(spark, folder).collect()
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["start"]), r["ids"]) for r in rows)
    assert [x[0][2] for x in got] == [sum(len(y[1]) // 4 for y in got[:i]) for i in range(len(got))]
    wanted = collections.Counter((r["doc_id"], np.array(ids_of(r["text"], 0), "<u4").tobytes()) for r in docs.collect())
    assert collections.Counter((r["doc_id"], r["ids"]) for r in rows) == wanted
    shard = shards.orderBy(F.desc("records")).first()
    last = records.read_record(shard["path"], shard["records"] - 1)
    assert last in wanted


def test_damage_is_found(spark, docs):
    folder = scratch_path(spark, "records")
    path = records.write_records(docs, folder).first()["path"]
    files, inside = records.store(path)
    with files.open_input_file(f"{inside}.rec") as file:
        data = bytearray(file.read())
    data[20] ^= 1
    with files.open_output_stream(f"{inside}.rec") as file:
        file.write(bytes(data))
    with pytest.raises(Exception, match="damaged"):
        records.read_records(spark, folder).collect()


def test_mix_meets_targets_and_limits(spark, docs):
    rows = mixing.mix_sources(docs).documents.collect()
    assert len(rows) == ROWS
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert collections.Counter((r["doc_id"], r["size"]) for r in rows) == collections.Counter(
        (r["doc_id"], size(r["text"])) for r in docs.collect()
    )
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    by = collections.defaultdict(lambda: [0, 0, 0.0])
    for r in rows:
        own = by[r["source"]]
        own[0] += r["size"]
        own[1] += r["taken"]
        own[2] = r["target"]
    assert sum(own[2] for own in by.values()) == pytest.approx(total)
    for have, taken, target in by.values():
        assert target <= 3 * have + 1e-9 and abs(taken - target) <= 0.02 * total / len(by) + 40
    again = mixing.mix_sources(docs.repartition(7)).documents.collect()
    assert collections.Counter(map(tuple, rows)) == collections.Counter(map(tuple, again))


@pytest.mark.parametrize("size", [300, 600, 2100])
def test_small_sources_meet_their_targets(spark, size):
    rows = [(i, "big", "w " * 30_000) for i in range(100)] + [(200 + i, "small", "w " * (size // 10)) for i in range(10)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    taken = mixing.mix_sources(table, block_words=2048).documents.where("source = 'small'").collect()
    assert sum(r["taken"] for r in taken) == pytest.approx(3 * size, rel=0.02) and taken[0]["target"] == 3 * size


def test_targets_reshare_the_excess(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), (None, 10)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert got == {"a": 960.0, "b": 30.0, None: 30.0}


def spans(text):
    luhn = lambda s: sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(s))) % 10 == 0
    out = []
    for kind, pattern in {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


HARD = [
    "a@b.c..d@e.f", "a@b.co_x@c.d x@y@z.com", "😀 a@b.co 1.2.3.4.5.6.7.8 0255.1.1.1 1.2.3.45", "4111-1111-1111-1111 4111  1111 1111 1111 1111",
    "+12 345 678 90+1 (2) 3", "1 " * 3000, "9" * 6000, "a." * 5000 + "@b" + ".c" * 5000, "+1" + " " * 4000, "00255.0.0.1", "+" * 2000,
]


def test_base_spans_match_plain_regular_expressions(spark, docs):
    more = spark.createDataFrame([(100 + i, text) for i, text in enumerate(HARD)], "doc_id long, text string")
    table = docs.select("doc_id", "text").unionByName(more)
    got = personal.find_personal(table).documents.select("doc_id", "text_key", "base").collect()
    wanted = collections.Counter(
        (r["doc_id"], tuple(spans(r["text"]))) for r in table.collect()
    )
    assert collections.Counter((r["doc_id"], tuple(map(tuple, r["base"]))) for r in got) == wanted


def test_contexts_find_unseen_identifiers_and_masks_hold(spark):
    rows = [(i, f"please reply to: user{i}@mail.example.com today") for i in range(6)]
    rows += [(10, "please reply to: user77(at)host.example today"), (11, "nothing 5 here"), (12, "😀 reply to: x1234y and a@b.co")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = personal.find_personal(table)
    got = {r["doc_id"]: r for r in found.documents.collect()}
    assert not got[10]["added"] and not got[11]["added"]  # two digits are no identifier
    assert [tuple(x) for x in got[12]["added"]] == [("email", 12, 18)] and len(got[12]["base"]) == 1
    assert {r["context"] for r in found.patterns.collect()} == {"reply to:"}
    masked = table.join(found.documents, "doc_id").select(
        "doc_id", personal.redacted(F.col("text"), F.concat("base", "added")).alias("text")
    )
    assert {r["doc_id"]: r["text"] for r in masked.collect()}[12] == "😀 reply to: [EMAIL] and [EMAIL]"


def test_toxicity_learns_noisy_labels(spark):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1200):
        bad = i % 6 == 0
        text = [*rng.choice(words, 60)]
        for at in rng.choice(60, 4) if bad else []:
            text[at] = rng.choice(["vile", "scum", "blightling", "blightrot"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad) if rng.random() > 0.03 else int(not bad)))
    docs = spark.createDataFrame([*rows, (5000, None), (5001, ""), (None, "scum vile")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels).collect()
    assert len(got) == 1203 and all(0 <= r["score"] <= 1 for r in got)
    known = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 1200]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in known)
    held = [r for r in known if r["held_out"]]
    assert np.mean([r["predicted"] == (r["doc_id"] % 6 == 0) for r in held]) > 0.97
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] in (5000, 5001))
    one = toxicity.score_toxicity(docs, labels.where("toxic = 0")).collect()
    assert len({r["score"] for r in one}) == 1


def plain_classes(rows):
    sets = [np.unique(shingle_hashes(text, 5), return_counts=True) for _, text in rows]
    counts = np.zeros(1 << 20, int)
    for hashes, _ in sets:
        counts[np.unique(bucket(hashes))] += 1
    idf = inverse_frequencies(sum(len(h) > 0 for h, _ in sets), counts)
    weights = [dict(zip(h.tolist(), n * idf[bucket(h)])) for h, n in sets]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = sum(min(w, weights[j][h]) for h, w in weights[i].items() if h in weights[j])
            every = sum(weights[i].values()) + sum(weights[j].values()) - both
            if every and both / every >= 0.8:
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    return [rows[x][0] for x in root]


def test_near_documents_match_all_pairs(spark):
    rows = []
    for i in range(40):
        words = prose(i % 12, 150).split()
        for at in range(0, (i // 12) * 2):
            words[(at * 37 + i) % 150] = f"edit{i}"
        rows.append((i, " ".join(words)))
    rows += [(50, BASE), (51, BASE.upper()), (52, "  " + BASE), (60, "two words"), (61, "two words"), (62, ""), (63, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["class_id"] for r in weighted_minhash.near_documents(table).collect()}
    assert [got[i] for i, _ in rows] == plain_classes(rows)


def test_samples_are_plain_ones_drawn_in_little_memory():
    rng = np.random.default_rng(4)
    hashes = np.unique(rng.integers(0, 2**63, 5000, np.uint64) * np.uint64(2))
    weights = rng.random(len(hashes)) * 9 + 0.1
    sampler = weighted_minhash.Sampler(40, 5)
    draw = (hashes[None, :] * sampler.factors[:, None]) >> np.uint64(64 - weighted_minhash.DRAWS_BITS)
    level = np.floor(np.log(weights) / sampler.rate[draw] + sampler.shift[draw])
    least = (sampler.log_c[draw] - sampler.rate[draw] * (level - sampler.shift[draw] + 1.0)).argmin(axis=1)
    level = level[np.arange(40), least].astype(np.int64).astype(np.uint64)
    wanted = mix(hashes[least] ^ (level * np.uint64(MIX_A)))
    tracemalloc.start()
    got = sampler.sample(hashes, weights)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(got, wanted)
    assert peak < 1_000_000  # blocks of 40 x 4096 numbers took 1.3 MB each


def test_large_buckets_are_compared_in_parts(spark, monkeypatch):
    monkeypatch.setattr(weighted_minhash, "PART", 4)
    words = prose(3, 200).split()
    rows = [(i, " ".join([*words[:i], f"new{i}", *words[i + 1 :]])) for i in range(30)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = weighted_minhash.near_documents(table).collect()
    assert {r["class_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


def test_near_documents_on_odd_rows(docs):
    got = weighted_minhash.near_documents(docs).collect()
    assert len(got) == ROWS
    by = {r["doc_id"]: r["class_id"] for r in got}
    assert by[4] == by[5] == by[6] == 4 and by[0] == 0 and by[1] == 1 and by[2] == 2 and by[None] is None
    assert all(r["kept"] for r in got if r["doc_id"] in (None, 0, 1, 2, 3))


def test_passages_cover_repeats(docs):
    got = chaining.repeated_passages(docs).collect()
    texts = dict(enumerate(TEXTS))
    found = {(r["doc_id"], r["with_id"]): texts[r["doc_id"]][r["start"] : r["end"]] for r in got}
    shared = " ".join(prose(5, 70).split())
    assert found[11, 12] == shared and found[12, 11] == shared
    assert found[4, 5] == BASE and found[5, 4] == BASE
    assert len(found[6, 4].split()) >= 155 and {r["doc_id"] for r in got} == {4, 5, 6, 11, 12}
    assert all(r["n_words"] > 50 and r["identity"] >= 0.8 for r in got)


def test_fenwick_chain_is_the_best_chain():
    rng = np.random.default_rng(3)
    for _ in range(20):
        x, y = rng.integers(0, 40, 15), rng.integers(0, 40, 15)
        best = max((e[0] - b[0] + 5 for chain in chaining.chains(x, y, 5, 0.1, 0, 1000) for b, e in [(chain[0], chain[-1])]), default=0)
        assert best >= 5
    line = np.arange(0, 100, 5)
    noise = np.array([3, 50, 77])
    got = chaining.chains(np.append(line, noise), np.append(line + 7, [90, 2, 30]), 5, 0.1, 20, 64)
    assert got[0] == [(int(a), int(a) + 7) for a in line]


@pytest.mark.parametrize("between", [65, 80, 300, 1000])
def test_second_passage_is_chained_behind_a_longer_one(spark, between):
    first, second = np.arange(0, 200, 5), 205 + between + np.arange(0, 100, 5)
    line = np.append(first, second)
    got = chaining.chains(line, line + 3, 5, 0.1, 20, 64)
    assert sorted(chain[0][0] for chain in got) == [0, second[0]] and sum(map(len, got)) == len(line)
    one, two = prose(30, 200), prose(31, 60)
    rows = [(i, f"{one} {prose(32 + i, between)} {two} {prose(40 + i, 30)}") for i in (1, 2)]
    found = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = dict(rows)
    assert sorted(texts[r["doc_id"]][r["start"] : r["end"]] for r in found) == sorted([one, two] * 2)


def test_passages_whose_seeds_have_scattered_first_places(spark):
    words = prose(50, 60).split()
    rows = [(i, f"{prose(60 + i, 30)} {' '.join(words[6 * i : 6 * i + 10])} {prose(80 + i, 30)}") for i in range(10)]
    rows += [(i, f"{prose(i, 40)} {' '.join(words)} {prose(i + 1, 40)}") for i in (900, 950)]
    # the first document repeats the passage inside itself, too
    rows += [(2000, f"{prose(2000, 40)} {BASE} {prose(2001, 40)} {BASE}"), (2001, f"{prose(2002, 40)} {BASE}")]
    found = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    texts = dict(rows)
    got = sorted((r["doc_id"], texts[r["doc_id"]][r["start"] : r["end"]]) for r in found)
    assert got == [(900, " ".join(words)), (950, " ".join(words)), (2000, BASE), (2000, BASE), (2001, BASE)]


def test_runs_inside_passages_are_not_written(spark):
    folder = Path(shared_dir(spark))
    before = set(folder.glob("runs-*"))
    rows = [(i, prose(70, 300)) for i in range(6)] + [(i, prose(i, 100)) for i in (20, 21)]
    found = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_words"]) for r in found) == [(i, 300) for i in range(6)]
    (written,) = set(folder.glob("runs-*")) - before
    assert spark.read.schema("open boolean").parquet(str(written)).count() < 300  # of 6 x 281


def test_wide_rows_of_passages_go_to_python_in_small_batches(spark, monkeypatch):
    def sizes(batches):
        for batch in batches:
            yield batch.assign(bytes=int(batch["text"].str.len().sum()))[["bytes"]]

    limits, write = [], chaining.cut_lineage

    def written(df, name="stage"):
        wide = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("abcde"), 10_000).alias("text"))
        limits.append((name, wide.mapInPandas(sizes, "bytes long").agg(F.max("bytes")).first()[0]))
        return write(df, name)

    monkeypatch.setattr(chaining, "cut_lineage", written)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    rows = [(i, prose(70, 60)) for i in range(2)]
    found = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert limits[-1][0] == "located" and max(most for _, most in limits) < 10_000_000  # 20 MB of rows
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
    assert sorted((r["doc_id"], r["n_words"]) for r in found.collect()) == [(0, 60), (1, 60)]


def test_tables_of_passages_go_after_their_last_use(spark):
    folder = Path(shared_dir(spark))
    before = set(folder.iterdir())
    rows = [(i, prose(70, 300)) for i in range(3)] + [(i, prose(i, 100)) for i in (20, 21)]
    found = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {path.name.rpartition("-")[0] for path in set(folder.iterdir()) - before}
    assert "texts" in left and not left & {"seeds", "hubs", "met", "shared", "spans"}
    assert sorted((r["doc_id"], r["n_words"]) for r in found.collect()) == [(i, 300) for i in range(3)]


def test_only_written_tables_are_deleted(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "own"))
    with pytest.raises(ValueError, match="cut_lineage"):
        drop_written(spark.read.parquet(str(tmp_path / "own")))
    assert spark.read.parquet(str(tmp_path / "own")).count() == 3


@pytest.mark.parametrize("apply", [
    packing.best_fit_sequences, lambda d: mixing.mix_sources(d).documents, lambda d: personal.find_personal(d).documents,
    weighted_minhash.near_documents, chaining.repeated_passages,
], ids=["packing", "mixing", "personal", "near", "passages"])
def test_empty_tables(empty, apply):
    assert apply(empty).count() == 0


def test_empty_tables_of_records_and_toxicity(spark, empty):
    folder = scratch_path(spark, "records")
    records.write_records(empty, folder)
    assert records.read_records(spark, folder).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_toxicity(empty, labels).count() == 0


def test_digest_is_plain():
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
