"""Fill-in-the-middle against a plain version on every odd case, and the SQL on the same rows."""

import hashlib

import duckdb
import pyarrow as pa

from sparkassay.llm import fim
from sparkassay.llm.queries import OP13_SQL, op13_fill_in_middle
from tests.llm.conftest import TEXTS


def plain_version(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:lo], text[lo:hi], text[hi:]
    if n == 0 or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        form, out = "plain", text
    elif h[3] % 100 < 20:
        form, out = "spm", f"<S>{suf}<P>{pre}<M>{mid}"
    else:
        form, out = "psm", f"<P>{pre}<S>{suf}<M>{mid}"
    plain = form == "plain"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, n, form, None if plain else lo, None if plain else hi - lo, sha(out), sha(text))


def key(row):
    return tuple(-1 if x is None else x for x in row)


def rows_of(df):
    return sorted((key(r) for r in df.collect())), [f.name for f in df.schema]


def test_query_equals_plain_version(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got, names = rows_of(op13_fill_in_middle(spark, str(tmp_path)))
    assert names == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    wanted = sorted(key(plain_version(r["doc_id"], r["text"])) for r in docs.collect())
    assert got == wanted
    assert {r[2] for r in got} >= {"plain", "psm"}
    sql = duckdb.connect()
    sql.register("documents", docs.toArrow())
    assert sorted(key(r) for r in sql.sql(OP13_SQL).fetchall()) == got


def test_many_ids_reach_every_form_and_round_trip(spark):
    text = "αβγ 😀 text with some words and \n lines " * 3
    rows = [(i, text) for i in range(400)] + [(400, "has <M> inside"), (401, None), (402, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = fim.fill_in_middle(df)
    got = out.select("doc_id", "fim_form", fim.restored(out["fim_output"], out["fim_form"]).alias("back"), "fim_output")
    got = {r["doc_id"]: r for r in got.collect()}
    assert {r["fim_form"] for r in got.values()} == {"plain", "psm", "spm"}
    assert all(r["back"] == (dict(rows)[i] or "") for i, r in got.items())
    assert got[400]["fim_form"] == got[401]["fim_form"] == got[402]["fim_form"] == "plain"
    for i, r in got.items():
        assert plain_version(i, dict(rows)[i])[5] == hashlib.sha256(r["fim_output"].encode()).hexdigest()


def test_clashing_columns_empty_table_and_slices(spark):
    df = spark.createDataFrame([(1, "abc", "x", 5)], "doc_id long, text string, fim_form string, fim_lo int")
    out = fim.fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "fim_lo", "fim_hi", "fim_form", "fim_output"]
    assert out.count() == 1
    assert fim.fill_in_middle(df.limit(0)).count() == 0
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 30, "c"]})
    parts = list(fim.slices(batch, "text", 12))
    assert [p.num_rows for p in parts] == [2, 1, 1] and sum(p.num_rows for p in parts) == 4


def test_slices_of_a_batch_give_the_same_outputs():
    """Slices whose offsets do not start at zero are cut exactly like the whole batch and like plain Python."""
    import numpy as np

    texts = [None, "", "abc", "é😀 mixed ünïcode", "x" * 5000, "tail text here"] * 7
    rng = np.random.default_rng(2)
    sizes = np.array([len(t or "") for t in texts])
    lo = (rng.random(len(texts)) * (sizes + 1)).astype(np.int64)
    hi = np.maximum(lo, (rng.random(len(texts)) * (sizes + 1)).astype(np.int64))
    forms = rng.choice(["plain", "psm", "spm"], len(texts))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array(lo), pa.array(hi), pa.array(forms)], names=["text", "fim_lo", "fim_hi", "fim_form"]
    )
    whole = fim.arrange(batch, "text").column("fim_output").to_pylist()
    cut = [x for part in fim.slices(batch, "text", 6000) for x in fim.arrange(part, "text").column("fim_output").to_pylist()]
    wanted = []
    for t, a, b, f in zip(texts, lo, hi, forms):
        s = t or ""
        wanted.append(s if f == "plain" else f"<P>{s[:a]}<S>{s[b:]}<M>{s[a:b]}" if f == "psm" else f"<S>{s[b:]}<P>{s[:a]}<M>{s[a:b]}")
    assert len(list(fim.slices(batch, "text", 6000))) > 3
    assert whole == cut == wanted
