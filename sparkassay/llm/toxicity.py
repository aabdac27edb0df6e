"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier on its posteriors."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkassay.session import cut_lineage

#: At most about this many labelled rows fit the model (those with the smallest hashes of their ids).
FIT_ROWS = 12_000
#: Lexicon entries kept: as voters, and as features of the classifier.
VOTERS, FEATURES = 48, 400
#: A lexicon voter fires where its entry makes up this share of the words.
SHARE = 0.003
STEMS = range(3, 8)
#: Pattern voters, each with the number of matches per word at which it fires.
PATTERNS = {
    r"!!": 0.02, r"\?\?": 0.02, r"[%$#&*]{3}": 0.2, r"\|": 0.2, r"\b[A-ZÄÖÜÉÈÑ]{4,}\b": 0.3, r"\b(\w+)(?: \1){3}\b": 0.002,
    r"(?i)\b(?:you|your|du|tu|vous|usted)\b": 0.01, r"(?i)\blicen[sc]e": 0.002, r"@|https?://|www\.": 0.002, r"\d": 0.05,
}


def entries(text: str | None) -> tuple[Counter, int]:
    """How often each whole word (``=word``) and each stem (``stem-``) occurs, and the number of words."""
    words = Counter(re.findall(r"\w+", (text or "").lower()))
    found: Counter = Counter()
    for word, n in words.items():
        found[f"={word}"] += n
        for size in STEMS:
            if len(word) > size:
                found[f"{word[:size]}-"] += n
    return found, sum(words.values())


def patterns(text: str | None, size: int) -> list[float]:
    """Matches per word of each pattern, relative to the share at which its voter fires."""
    return [len(re.findall(one, text or "")) / max(size, 1) / share for one, share in PATTERNS.items()]


def unlike(found: list[tuple[str, int, int]]) -> list[str]:
    """Entries without those that fire on as many rows as a longer one they begin."""
    longer: dict[tuple[int, int], list[str]] = {}
    for entry, n0, n1 in sorted(found, key=lambda one: -len(one[0].strip("=-"))):
        own = longer.setdefault((n0, n1), [])
        if not any(other.strip("=-").startswith(entry.strip("=-")) for other in own):
            own.append(entry)
    return [entry for entry, n0, n1 in found if entry in longer[n0, n1]]


@dataclass(frozen=True)
class Model:
    """A linear classifier: weights of lexicon entries and patterns, and what the label model found."""

    lexicon: dict[str, int]
    weights: np.ndarray
    intercept: float
    accuracy: dict[str, tuple[float, float]]

    def features(self, text: str | None) -> np.ndarray:
        words = Counter(re.findall(r"\w+", (text or "").lower()))
        size = sum(words.values())
        counts = np.zeros(len(self.lexicon))
        get = self.lexicon.get
        for word, n in words.items():
            at = get(f"={word}")
            if at is not None:
                counts[at] += n
            for end in STEMS:
                if len(word) <= end:
                    break
                at = get(f"{word[:end]}-")
                if at is not None:
                    counts[at] += n
        shares = np.concatenate([counts / max(size, 1) / SHARE, patterns(text, size)])
        return np.log1p(shares)

    def score(self, text: str | None) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.features(text) @ self.weights + self.intercept, -30, 30))))


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each row, and per voter the chance to fire for either class (last row: the annotators).

    Expectation maximisation of a mixture of two classes in which voters fire or not. Voters that fire together more
    often than the classes explain share one vote: each weighs one over its summed correlation with all others.
    """
    fired = np.column_stack([votes, labels]).astype(float)
    chance = np.where(labels > 0, 0.9, 0.05)
    weight = np.ones(fired.shape[1])
    rates = np.zeros((2, fired.shape[1]))
    for turn in range(rounds):
        both = np.stack([1 - chance, chance])
        size = both.sum(axis=1)
        rates = (both @ fired + 0.5) / (size + 1.0)[:, None]
        prior = (size + 1.0) / (size.sum() + 2.0)
        if turn % 5 == 0:
            rest = fired - both.T @ rates  # what the classes leave unexplained
            scale = np.sqrt((rest**2).sum(axis=0) + 1e-9)
            correlation = (rest.T @ rest) / scale[:, None] / scale[None, :]
            np.fill_diagonal(correlation, 1.0)
            weight = 1.0 / np.where(correlation > 0.3, correlation, 0.0).sum(axis=1)
            weight[-1] = 1.0  # people are not among the voters that copy each other
        evidence = (fired * weight) @ np.log(rates).T + ((1 - fired) * weight) @ np.log(1 - rates).T + np.log(prior)
        chance = 1.0 / (1.0 + np.exp(np.clip(evidence[:, 0] - evidence[:, 1], -500, 500)))
    return chance, rates


def fit_linear(x: np.ndarray, target: np.ndarray, penalty: float = 1.0, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps."""
    size = x.shape[1] + 1
    ridge = np.full(size, penalty)
    ridge[-1] = 1e-6
    weights = np.zeros(size)
    for _ in range(rounds):
        slope, curve = -ridge * weights, np.diag(ridge)
        for at in range(0, len(x), 2000):
            own = np.column_stack([x[at : at + 2000].astype(float), np.ones(len(x[at : at + 2000]))])
            p = 1.0 / (1.0 + np.exp(-np.clip(own @ weights, -30, 30)))
            slope = slope + own.T @ (target[at : at + 2000] - p)
            curve = curve + (own * (p * (1 - p) + 1e-9)[:, None]).T @ own
        step = np.linalg.solve(curve, slope)
        weights += step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return weights[:-1], float(weights[-1])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, fit_rows: int = FIT_ROWS) -> Model:
    """A model from labelled rows; ``labels`` holds only rows that it may learn from.

    Labelled ids are reduced to the ``fit_rows`` with the smallest hashes (a bound, so the join may broadcast them).
    Entries that fire far more often in one class than in the other become lexicon voters and features.
    """
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    one = one.agg(F.max(F.col(label_col).cast("int")).alias("label"))
    count = one.count()
    if count > fit_rows:
        one = one.where(F.abs(F.xxhash64("id") % 1_000_003) < int(1_000_003 * fit_rows / count))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = cut_lineage(texts.join(F.broadcast(one), "id").drop("id"), "labelled")
    sizes = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)

    def count_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                found, size = entries(text)
                totals[label > 0].update(name for name, n in found.items() if n >= SHARE * size)
        every = list(totals[0] | totals[1])
        for at in range(0, len(every), 50_000):
            names = every[at : at + 50_000]
            yield pd.DataFrame({
                "entry": np.array(names, object), "n0": [totals[0][x] for x in names], "n1": [totals[1][x] for x in names],
            })

    counted = sample.mapInPandas(count_entries, "entry string, n0 long, n1 long").groupBy("entry")
    counted = counted.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where("n1 >= 3")
    both, every = F.col("n1") + F.col("n0"), max(n1 + n0, 1)
    part = lambda n, of: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) * every / both / max(of, 1))).otherwise(0.0)
    ratio = counted.where(F.col("n1") * n0 > F.col("n0") * n1).withColumn("ratio", part("n1", n1) + part("n0", n0))
    best = ratio.where("ratio > 6").orderBy(F.desc("ratio"), "entry").limit(4 * FEATURES).collect()
    lexicon = unlike([(row["entry"], row["n0"], row["n1"]) for row in best])[:FEATURES]
    model = Model({entry: at for at, entry in enumerate(lexicon)}, np.zeros(len(lexicon) + len(PATTERNS)), 0.0, {})
    if not n0 or not n1:  # nothing to tell apart: the share of toxic rows, one half without any
        return Model(model.lexicon, model.weights, float(np.log((n1 + 0.5) / (n0 + 0.5))), {})

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = [model.features(text).astype("<f4").tobytes() for text in batch["text"]]
            yield pd.DataFrame({"features": packed, "label": batch["label"]})

    rows = sample.mapInPandas(describe, "features binary, label int").toPandas()  # bounded by fit_rows
    y = (rows["label"].to_numpy() > 0).astype(float)
    x = np.frombuffer(b"".join(rows.pop("features")), "<f4").reshape(len(rows), -1)
    voters = [*range(min(VOTERS, len(lexicon))), *range(len(lexicon), x.shape[1])]
    chance, rates = label_model(x[:, voters] >= np.float32(np.log(2.0)), y)
    weights, intercept = fit_linear(x, chance)
    names = [*lexicon[:VOTERS], *PATTERNS, "annotators"]
    accuracy = {name: (float(a), float(b)) for name, a, b in zip(names, rates[0], rates[1])}
    return Model(model.lexicon, weights, intercept, accuracy)


def scorer(model: Model):
    """A function of a text column that gives its scores."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(text) for text in texts], dtype=float)

    return score


def held_out(doc_id: Column, folds: int) -> Column:
    """True for ids in the fold that nothing learns from; a null id is in none."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    folds: int = 5, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``id_col, held_out, score, predicted`` for every document; only its text enters the score.

    Labels whose crc32(id as text) is divisible by ``folds`` are held out. From at most ``fit_rows`` others a lexicon
    of words and word stems is induced; lexicon and pattern voters fire or abstain on each text; a generative model
    estimates how often each fires for either class, how voters correlate and how reliable the labels are; a linear
    classifier learns its posteriors from the share of words that each entry makes up. Whole texts are read.

    Null and empty texts get the score of a text without evidence. Null or repeated ids are scored row by row (a null
    id is never held out). Null labels are ignored, the highest of repeated ones counts. Without labels of both
    classes the score is the share of toxic labels (0.5 without any). Empty tables give no rows.
    """
    learn = labels.where(~held_out(F.col(id_col), folds))
    model = fit(docs, learn, id_col=id_col, text_col=text_col, label_col=label_col, fit_rows=fit_rows)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col), held_out(F.col(id_col), folds).alias("held_out"), scorer(model)(text).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
