"""Secrets in text: fixed formats, and strings in a sensitive context that a primed zstandard cannot compress.

Base spans are found by three regular expressions (leftmost, non-overlapping per kind; a match that fails its length
condition is dropped, not retried). The method then looks at every other candidate string (a run of key characters
with letters and digits, 12 long or longer) that follows a sensitive word on its line and measures its
novelty: the bytes it adds when compressed after the text before it (the surrounding code), with a zstandard raw
dictionary of the corpus's most frequent identifier words, divided by its length. Words, identifiers and anything
that repeats text seen before cost a few bytes; keys, tokens and passwords made of random characters cost one byte a
character. Candidates at or above ``NOVELTY`` are added as kind ``novel``.

Spark counts the identifier words of all documents (map-side partial counts, one shuffle of distinct words) and keeps
those at or above the count threshold that leaves at most ``DICT_WORDS`` of them, so the dictionary's size is bounded by
that parameter; words with digits never
enter it, so a secret repeated in many copies stays novel. Scanning runs in Arrow batches per task.

Cases: a null text is empty (no spans); spans are in code points, end exclusive; a very long text costs time in
proportion to its length plus a fixed window per candidate; repeated rows give equal spans; an empty table gives an
empty result; input columns named ``secret_base`` or ``secret_added`` are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from sparkassay.llm.common import worker_state

#: The kinds in order and their patterns with the least length of the checked part.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}

#: Words after which a string is in a sensitive context (the method's own choice, any case).
SENSITIVE = re.compile(
    r"pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth\w*|bearer|credential\w*"
    r"|signature|session[_-]?id|\bkey\b",
    re.I | re.A,
)
# whole runs of key characters, 12 or more, holding a digit and a letter
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{12,}", re.A)
# whole tokens of letters and underscores only, so that no piece of a key or token enters the dictionary
IDENTIFIER = r"(?<![A-Za-z0-9+/=_.-])[A-Za-z_]{3,}(?![A-Za-z0-9+/=_-])"
CONTEXT, REACH = 256, 40
NOVELTY = 0.85
DICT_WORDS = 8192
SPAN = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])
OUTPUTS = ("secret_base", "secret_added")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = []
    for m in ASSIGN.finditer(text):
        if len(m.group(2)) >= LEAST["assign"]:
            spans.append(("assign", m.start(), m.end()))
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        spans.extend((kind, m.start(), m.end()) for m in pattern.finditer(text) if m.end() - m.start() >= LEAST[kind])
    return spans


def novelty(compressor: zstandard.ZstdCompressor, before: str, candidate: str) -> float:
    """Bytes the candidate adds to the compressed text before it, per character."""
    head = before.encode()
    return (len(compressor.compress(head + candidate.encode())) - len(compressor.compress(head))) / len(candidate)


def added_spans(
    text: str, base: list[tuple[str, int, int]], compressor: zstandard.ZstdCompressor, threshold: float
) -> list[tuple[str, int, int]]:
    covered = sorted((s, e) for _, s, e in base)
    found = []
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        if any(s < end and start < e for s, e in covered):
            continue
        line = text.rfind("\n", 0, start) + 1
        if not SENSITIVE.search(text, max(line, start - REACH), start):
            continue
        if novelty(compressor, text[max(0, start - CONTEXT) : start], m.group()) >= threshold:
            found.append(("novel", start, end))
    return found


def identifier_dictionary(docs: DataFrame, text_col: str, words: int) -> bytes:
    """The identifier words of all texts whose count reaches the least count that keeps at most ``words`` of them,
    most frequent last (nearest to the data).

    The threshold comes from the histogram of counts (one row per distinct count, summed in Spark), so no more than
    ``words`` words ever reach the driver, however many partitions or words there are.
    """
    found = F.explode(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(IDENTIFIER), 0))
    counts = docs.select(found.alias("w")).groupBy("w").count()
    hist = counts.groupBy(F.col("count").alias("c")).agg(F.count(F.lit(1)).alias("k"))
    running = hist.withColumn("kept", F.sum("k").over(Window.orderBy(F.desc("c"))))
    least = running.where(F.col("kept") <= words).agg(F.min("c").alias("c")).first()["c"]
    if least is None:
        return b""
    top = counts.where(F.col("count") >= least).collect()
    top.sort(key=lambda r: (r["count"], r["w"]))
    return "\n".join(r["w"] for r in top).encode()


def find_secrets(
    docs: DataFrame, text_col: str = "text", threshold: float = NOVELTY, dictionary_words: int = DICT_WORDS
) -> DataFrame:
    """Adds ``secret_base`` and ``secret_added`` (arrays of kind, start, end) to every row."""
    raw = identifier_dictionary(docs, text_col, dictionary_words)
    kept = [c for c in docs.columns if c not in OUTPUTS]
    rows = docs.select(*kept)
    spans = ArrayType(SPAN, containsNull=False)
    schema = StructType([*rows.schema.fields, StructField("secret_base", spans), StructField("secret_added", spans)])
    arrow_span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    key = f"secrets-{hash(raw)}"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make():
            primed = zstandard.ZstdCompressionDict(raw or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(level=3, dict_data=primed, write_checksum=False, write_content_size=False)

        compressor = worker_state(key, make)
        for batch in batches:
            base, added = [], []
            for text in batch.column(text_col).to_pylist():
                own = base_spans(text or "")
                base.append([dict(kind=k, start=s, end=e) for k, s, e in own])
                more = added_spans(text or "", own, compressor, threshold)
                added.append([dict(kind=k, start=s, end=e) for k, s, e in more])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(base, arrow_span), pa.array(added, arrow_span)],
                names=[*batch.schema.names, "secret_base", "secret_added"],
            )

    return rows.mapInArrow(scan, schema)


def in_order(spans: Column, kinds: tuple[str, ...] = (*KINDS, "novel")) -> Column:
    """Spans sorted by start, then kind as listed."""
    order = F.array(*map(F.lit, kinds))
    keyed = F.transform(spans, lambda x: F.struct(x["start"].alias("s"), F.array_position(order, x["kind"]).alias("k"), x["end"].alias("e"), x["kind"].alias("kind")))
    return F.transform(F.sort_array(keyed), lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("start"), x["e"].alias("end")))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
