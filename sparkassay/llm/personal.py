"""Personal data by fixed formats and by bootstrapped contexts, with DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.session import cut_lineage

#: Kinds in their order and their formats. Possessive quantifiers and looks behind match the same texts
#: as the plain formats but neither backtrack nor start inside a run that failed, so long runs cost linear time.
FORMATS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(FORMATS)
#: A token that may be an identifier: from one white space to the next, with a digit or an at sign.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: A pattern needs this many different seeds of a kind, and it and what it finds this score.
SEEDS, SCORE, ROUNDS = 3, 0.75, 3


@dataclass(frozen=True)
class Findings:
    """``documents``: a row per document with its spans; ``patterns``: contexts with their kind and score."""

    documents: DataFrame
    patterns: DataFrame


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the checksum of up to 19 digits is right."""
    back = F.reverse(digits)
    one = lambda i: F.substring(back, i, F.lit(1)).cast("int")
    part = lambda i: F.when(i % 2 == 1, one(i)).otherwise(one(i) * 2 - F.when(one(i) > 4, 9).otherwise(0))
    places = F.sequence(F.lit(1), F.char_length(digits))
    return F.aggregate(places, F.lit(0), lambda total, i: total + part(i)) % 10 == 0


def valid(kind: Column, found: Column) -> Column:
    """Whether a match of a format counts."""
    number = lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "")
    small = lambda part: (F.char_length(number(part)) <= 3) & (F.lpad(number(part), 3, "0") <= "255")
    digits = digits_of(found)
    size = F.char_length(digits)
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", F.forall(F.split(found, r"\."), small))
        .when(kind == "card", size.between(16, 19) & F.when(size.between(16, 19), luhn(digits)).otherwise(False))
        .otherwise(size.between(8, 15))
    )


def place(df: DataFrame, found: str, gaps: str, *keys: str, more: tuple[str, ...] = ()) -> DataFrame:
    """A row per element of ``found`` with ``start`` and ``end`` in code points; ``gaps`` are the lengths before them."""
    rows = df.where(F.size(found) > 0).select(*keys, F.posexplode(F.arrays_zip(F.col(found).alias("found"), gaps, *more)))
    rows = rows.select(*keys, "pos", "col.found", *(f"col.{x}" for x in more), F.col(f"col.{gaps}").alias("gap"))
    rows = rows.where(F.col("found").isNotNull())  # not what follows the last match
    size = F.char_length("found")
    ends = F.sum(F.col("gap") + size).over(Window.partitionBy(*keys).orderBy("pos"))
    return rows.withColumn("end", ends.cast("long")).withColumn("start", F.col("end") - size).drop("gap", "pos")


def find_personal(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Findings:
    """Spans of personal data of every document, in code points, end exclusive.

    ``documents``: ``id_col, text_key, base, added``; both are arrays of ``(kind, start, end)`` in the order of kinds,
    then starts. Base spans match one of the fixed formats (leftmost, non-overlapping per kind) and its check.

    Base spans seed the rest: the two words before a seed are a lexical pattern of its kind. Every token with a digit
    or an at sign is an instance of the pattern before it. A pattern's score is the mean score of its different
    instances (a seed counts 1), an instance's the probability that one of its patterns is right; both are computed
    in turn, ``ROUNDS`` times, over the graph of patterns with ``SEEDS`` or more different seeds. Instances of
    patterns with a score of ``SCORE`` that look like an identifier (four digits or an at sign) become added spans.

    Only matches and the lengths between them are shuffled, never texts; totals are pre-aggregated per pattern, and
    tables that meet in a join are written first, so that adaptive execution can split a hot pattern.

    A null text is an empty one and has no spans. Null and repeated ids are rows like all others (``text_key`` tells
    rows with one id apart). An empty table gives no rows. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"),
        text.alias("text"),
    )
    columns = ["row", "id", "text_key"]
    none, no_gaps = F.array().cast("array<string>"), F.array().cast("array<int>")
    hints = {"email": F.col("text").contains("@"), "ip": F.col("text").rlike(r"[0-9]\.[0-9]"), "phone": F.col("text").contains("+")}
    able = F.col("text").rlike("[0-9@]")
    lengths = lambda pattern: F.transform(F.split("text", pattern, -1), F.char_length)
    for kind, pattern in FORMATS.items():
        when = able & hints.get(kind, F.lit(True))
        columns.append(F.when(when, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none).alias(kind))
        columns.append(F.when(when, lengths(pattern)).otherwise(no_gaps).alias(f"{kind}_gaps"))
    before = F.transform(
        F.split("text", TOKEN, -1),
        lambda gap: F.lower(F.regexp_extract(F.substring(gap, -80, 80), r"(?:^|\s)(\S+\s+\S+)\s*$", 1)),
    )
    columns.append(F.when(able, F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))).otherwise(none).alias("token"))
    columns.append(F.when(able, lengths(TOKEN)).otherwise(no_gaps).alias("token_gaps"))
    columns.append(F.when(able, before).otherwise(none).alias("context"))
    matched = cut_lineage(numbered.select(*columns), "matches")

    hits = matched.select("row", F.explode(F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("found"), F.col(f"{kind}_gaps").alias("gaps")) for kind in KINDS
    ])).alias("hit")).select("row", "hit.kind", "hit.found", "hit.gaps")
    base = place(hits, "found", "gaps", "row", "kind").where(valid(F.col("kind"), F.col("found")))
    base = cut_lineage(base, "base")

    # tokens with the words before them; a token in which a base span starts is a seed of its kind
    tokens = place(matched, "token", "token_gaps", "row", more=("context",))
    trimmed = F.regexp_replace("found", r"""^[("'\[<{,;:]+|[)"'\]>},;:.!?%$#&*]+$""", "")
    lead = F.char_length(F.regexp_extract("found", r"""^[("'\[<{,;:]+""", 0))
    tokens = tokens.where("context <> ''").select(
        "row", F.trim(F.regexp_replace("context", r"\s+", " ")).alias("context"), "start", "end", trimmed.alias("token"),
        (F.col("start") + lead).alias("first"),
    )
    tokens = cut_lineage(tokens, "tokens")
    spans = base.select("row", "kind", F.col("start").alias("from"), F.col("end").alias("to"))
    over = tokens.join(spans, "row").where("from < end and to > start")
    over = over.groupBy("row", "start").agg(
        F.min_by("kind", F.struct("from", "kind")).alias("kind"), F.min("from").alias("from"),
    )
    tokens = tokens.join(over, ["row", "start"], "left").withColumn("inside", F.col("from").isNotNull() & (F.col("from") < F.col("start")))
    tokens = tokens.where(~F.col("inside")).select("row", "context", "token", "kind", "first")
    tokens = cut_lineage(tokens, "instances")

    seeds = tokens.where("kind is not null").groupBy("context", "kind", "token").agg(F.count("*").alias("n"))
    able_patterns = seeds.groupBy("context", "kind").agg(F.count("*").alias("seeds")).where(F.col("seeds") >= SEEDS)
    able_patterns = cut_lineage(able_patterns.select("context", F.col("kind").alias("as_kind")), "patterns")
    edges = tokens.join(able_patterns, "context").groupBy("context", "as_kind", "token").agg(
        F.max((F.col("kind") == F.col("as_kind")).cast("double")).alias("seed")
    )
    edges = cut_lineage(edges.withColumn("seed", F.coalesce("seed", F.lit(0.0))), "edges")
    scores = edges.groupBy("as_kind", "token").agg(F.max("seed").alias("score"))
    patterns = able_patterns.withColumn("pattern_score", F.lit(0.0))
    for _ in range(ROUNDS):
        scores = cut_lineage(scores, "scores")
        patterns = edges.join(scores, ["as_kind", "token"]).groupBy("context", "as_kind").agg(F.avg("score").alias("pattern_score"))
        patterns = cut_lineage(patterns, "patterns")
        wrong = F.exp(F.sum(F.log1p(-F.least("pattern_score", F.lit(0.999999)))))
        scores = edges.join(patterns, ["context", "as_kind"]).groupBy("as_kind", "token").agg(
            F.greatest(F.max("seed"), 1 - wrong).alias("score")
        )
    good = patterns.where(F.col("pattern_score") >= SCORE)
    looks = (F.char_length(digits_of(F.col("token"))) >= 4) | F.col("token").contains("@")
    added = tokens.where(F.col("kind").isNull() & looks).join(good, "context").select(
        "row", F.col("as_kind").alias("kind"), F.col("first").alias("start"),
        (F.col("first") + F.char_length("token")).alias("end"),
    ).distinct()

    every = base.select("row", "kind", "start", "end", F.lit(False).alias("added")).unionByName(
        added.withColumn("added", F.lit(True))
    )
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    lists = every.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct(order.alias("nth"), "start", "end", "kind", "added"))).alias("spans")
    )
    pick = lambda added: F.transform(
        F.filter("spans", lambda x: x["added"] == added), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
    )
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    documents = matched.select("row", "id", "text_key").join(lists, "row", "left").select(
        F.col("id").alias(id_col), "text_key", F.coalesce(pick(False), empty).alias("base"), F.coalesce(pick(True), empty).alias("added")
    )
    return Findings(documents, patterns.withColumnRenamed("as_kind", "kind"))


def in_order(spans: Column) -> Column:
    """Spans sorted by kind as listed, then start."""
    kinds = F.array(*map(F.lit, KINDS))
    keyed = F.transform(spans, lambda x: F.struct(F.array_position(kinds, x["kind"]).alias("nth"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    return F.transform(F.sort_array(keyed), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; where spans overlap, the first stays."""
    points = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    by_place = F.sort_array(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<from:bigint,start:bigint,end:bigint,kind:string>>").alias("cuts"))

    def add(state: Column, x: Column) -> Column:
        own = F.array(F.struct(state["at"].alias("from"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
        more = F.struct(x["end"].alias("at"), F.concat(state["cuts"], own).alias("cuts"))
        return F.when(x["start"] >= state["at"], more).otherwise(
            F.struct(F.greatest(state["at"], x["end"]).alias("at"), state["cuts"].alias("cuts"))
        )

    state = F.aggregate(by_place, none, add)
    part = lambda begin, end: F.array_join(F.slice(points, (begin + 1).cast("int"), (end - begin).cast("int")), "")
    pieces = F.transform(state["cuts"], lambda x: F.concat(part(x["from"], x["start"]), F.lit("["), F.upper(x["kind"]), F.lit("]")))
    return F.concat(F.array_join(pieces, ""), part(state["at"], F.size(points)))
