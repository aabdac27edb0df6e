"""Repeated passages by collinear chaining: shared word seeds, chains through a Fenwick tree, alignment of chains."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.llm.common import small_batches
from sparkassay.llm.shingles import STEP, mix, word_hashes
from sparkassay.session import cut_lineage, drop_written

#: Scores of aligned words, and how far an extension may fall below its best before it stops.
MATCH, MISMATCH, DROP = 1, -2, 12
#: Words around a chain that are fetched for its alignment.
MARGIN = 48
#: Which code points are white space; there is none from U+3001 on.
SPACES = np.array([chr(code).isspace() for code in range(0x3002)])


def chunks(texts: pd.Series, chars: int = 1 << 20) -> Iterator[slice]:
    """Slices of a batch with about that many characters each, at least one text."""
    begin, total = 0, 0
    for at, size in enumerate(texts.str.len().fillna(0).astype(int).to_numpy()):
        if total and total + size > chars:
            yield slice(begin, at)
            begin, total = at, 0
        total += size
    if len(texts):
        yield slice(begin, len(texts))


def hashes_of(words: list[str]) -> np.ndarray:
    """``word_hashes`` of words that are in lower case already."""
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False) if words else np.empty(0, np.uint64)


def word_bounds(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the white-space separated words of a text begin and end, in code points."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    edges = np.diff(np.concatenate([[False], ~SPACES[np.minimum(codes, len(SPACES) - 1)], [False]]).astype(np.int8))
    return np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)


def runs_of(words: np.ndarray, width: int) -> np.ndarray:
    """``shingle_hashes`` of every run of ``width`` words, also of those that cross the end of a text."""
    count = max(0, len(words) - width + 1)
    total = np.full(count, width, np.uint64)
    for at in range(width):
        total = total * np.uint64(STEP) + words[at : at + count]
    return mix(total)


def within(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For parts of these sizes end to end: the part of each element, and its place there."""
    part = np.repeat(np.arange(len(sizes)), sizes)
    return part, np.arange(len(part)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def seeds(texts: Iterable[str | None], width: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, texts (by number), positions, and whether the text has it there first, of the smallest seed of each window of seeds (a run of
    ``width + window - 1`` equal words therefore has an equal seed); every seed of a text with fewer."""
    split = [(text or "").lower().split() for text in texts]
    words, sizes = hashes_of(list(itertools.chain.from_iterable(split))), np.array([len(own) for own in split], np.int64)
    part, at = within(sizes)
    inside = at + width <= sizes[part]
    hashes = runs_of(words, width)[inside[: max(0, len(words) - width + 1)]]
    part, at = part[inside], at[inside]
    counts = np.maximum(sizes - width + 1, 0)
    # first smallest of a window: spans are doubled, and the last step overlaps
    low, place, span = hashes, np.arange(len(hashes)), 1
    while span < window and len(low):
        step = min(span, window - span)
        right = low[step:] < low[: len(low) - step]
        place = np.where(right, place[step:], place[: len(place) - step])
        low, span = hashes[place], span + step
    used = counts[part] <= window
    used[place[at[: len(place)] + window <= counts[part[: len(place)]]]] = True
    hashes, part, at = hashes[used], part[used], at[used]
    # places of a seed that a text repeats also get the name of seed and turn, so that turns can match each other
    order = np.lexsort((hashes, part))
    same = np.append(False, (hashes[order][1:] == hashes[order][:-1]) & (part[order][1:] == part[order][:-1]))[: len(order)]
    begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    turn = np.empty(len(order), np.uint64)
    turn[order] = np.arange(len(order)) - begin
    later = turn > 0
    again = mix(hashes[later] + turn[later] * np.uint64(STEP))
    return np.append(hashes, again), np.append(part, part[later]), np.append(at, at[later]), np.append(~later, later[later])


class Fenwick:
    """Largest value over a prefix of positions, and where it came from."""

    def __init__(self, size: int):
        self.best = [(-1e18, -1)] * (size + 1)

    def put(self, at: int, value: tuple[float, int]) -> None:
        at += 1
        while at < len(self.best):
            if self.best[at] < value:
                self.best[at] = value
            at += at & -at

    def get(self, before: int) -> tuple[float, int]:
        """The largest among positions smaller than ``before``."""
        found = (-1e18, -1)
        while before > 0:
            found = max(found, self.best[before])
            before -= before & -before
        return found


def chains(x: np.ndarray, y: np.ndarray, width: int, gap: float, least: int, reach: int) -> list[list[int]]:
    """Chains of matches that rise in both texts. A match scores the words it adds, and ``gap`` is paid for every word
    between neighbours in either text; with costs linear in both, the best predecessor is a prefix maximum. Where that
    one lies more than ``reach`` words back, the matches within reach are looked through instead."""
    order = np.lexsort((y, x))
    heights = y[order].astype(int)
    places = np.unique(heights)
    rank = np.searchsorted(places, heights).tolist()
    x, y = x[order].astype(int).tolist(), heights.tolist()  # single numbers are read faster from lists
    tree, score, back = Fenwick(len(places)), [0.0] * len(x), [-1] * len(x)
    waiting: list[int] = []
    low = 0
    for at in range(len(x)):
        while x[at] - x[low] > reach:
            low += 1
        if waiting and x[waiting[0]] != x[at]:  # matches of one position do not follow each other
            for other in waiting:
                tree.put(rank[other], (score[other] + gap * (x[other] + y[other]), other))
            waiting = []
        value, before = tree.get(rank[at])
        score[at] = width
        if before >= 0 and (x[at] - x[before] > reach or y[at] - y[before] > reach):
            last = waiting[0] if waiting else at
            near = low + np.flatnonzero((heights[low:last] < y[at]) & (y[at] - heights[low:last] <= reach))
            value, before = max(((score[i] + gap * (x[i] + y[i]), i) for i in near.tolist()), default=(-1e18, -1))
        if before >= 0:
            added = min(width, x[at] - x[before], y[at] - y[before])
            joined = value - gap * (x[at] + y[at]) + added
            if joined > score[at]:
                score[at], back[at] = joined, before
        waiting.append(at)
    used, out = np.zeros(len(x), bool), []
    for at in np.argsort(-np.array(score), kind="stable").tolist():
        chain = []
        while at >= 0 and not used[at]:
            used[at] = True
            chain.append(at)
            at = back[at]
        if chain:
            chain.reverse()
            if x[chain[-1]] - x[chain[0]] + width >= least:
                out.append([(x[i], y[i]) for i in chain])
    return out


def straight(one: np.ndarray, two: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per row, how many of the first ``sizes`` words align one to one before the score has fallen by ``DROP`` from its
    best."""
    if not one.size:
        return np.zeros(len(one), np.int64)
    equal = (one == two) & (np.arange(one.shape[1]) < sizes[:, None])
    total = np.cumsum(np.where(equal, MATCH, MISMATCH), axis=1)  # words behind the sizes only lower it
    highest = np.maximum.accumulate(np.maximum(total, 0), axis=1)
    total[np.logical_or.accumulate(highest - total > DROP, axis=1)] = MISMATCH
    return np.where(total.max(axis=1) > 0, total.argmax(axis=1) + 1, 0)


def extend(one: list[np.ndarray], two: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per pair, words of both that align from their starts; after a straight run up to three words may be left out of
    one."""

    def table(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(row) for row in rows], np.int64)
        out = np.zeros((len(rows), sizes.max(initial=0)), np.uint64)
        part, at = within(sizes)
        out[part, at] = np.concatenate([*rows, np.empty(0, np.uint64)])
        return out, sizes

    (one, one_sizes), (two, two_sizes) = table(one), table(two)

    def aligned(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        left = np.maximum(np.minimum(one_sizes[rows] - a, two_sizes[rows] - b), 0)
        line = np.arange(left.max(initial=0))
        first = np.minimum(a[:, None] + line, max(one.shape[1] - 1, 0))
        second = np.minimum(b[:, None] + line, max(two.shape[1] - 1, 0))
        return straight(one[rows[:, None], first], two[rows[:, None], second], left)

    rows = np.arange(len(one))
    a = aligned(rows, np.zeros(len(one), np.int64), np.zeros(len(one), np.int64))
    b = a.copy()
    while True:
        rows = rows[np.minimum(one_sizes[rows] - a[rows], two_sizes[rows] - b[rows]) >= 4]
        if not len(rows):
            return a, b
        gain, shift = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for s in (1, -1, 2, -2, 3, -3):  # of equal gains the first
            own = aligned(rows, a[rows] + max(s, 0), b[rows] + max(-s, 0))
            gain, shift = np.where(own > gain, own, gain), np.where(own > gain, s, shift)
        more = gain >= 4
        rows, gain, shift = rows[more], gain[more], shift[more]
        a[rows] += np.maximum(shift, 0) + gain
        b[rows] += np.maximum(-shift, 0) + gain


def common(one: np.ndarray, two: np.ndarray) -> int:
    """Length of the longest common subsequence of two short runs, a bit per word of the second (Hyyro 2004)."""
    if len(one) == len(two) and (one == two).all():
        return len(one)
    places: dict[int, int] = {}
    for at, word in enumerate(two.tolist()):
        places[word] = places.get(word, 0) | 1 << at
    every = (1 << len(two)) - 1
    row = every
    for word in one.tolist():
        met = row & places.get(word, 0)
        if met:
            row = (row + met | row - met) & every
    return len(two) - row.bit_count()


def align(
    one: list[np.ndarray], two: list[np.ndarray], x: np.ndarray, y: np.ndarray, x_end: np.ndarray, y_end: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per pair, bounds of the passage around the chain from (x, y) to the ends, and the share of equal words in it."""
    left = extend([own[:i][::-1] for own, i in zip(one, x)], [own[:i][::-1] for own, i in zip(two, y)])
    right = extend([own[i:] for own, i in zip(one, x_end)], [own[i:] for own, i in zip(two, y_end)])
    a, b, c, d = x - left[0], x_end + right[0], y - left[1], y_end + right[1]
    same = np.array([common(p[i:j], q[k:m]) for p, q, i, j, k, m in zip(one, two, a, b, c, d)], np.float64)
    return a, b, c, d, same / np.maximum(b - a, d - c)


def near_matches(batches: Iterator[pd.DataFrame], least: int, reach: int) -> Iterator[pd.DataFrame]:
    """Of matches in the order of id, hub and at, the longest runs of one id and hub without a gap over ``reach``, as no
    chain crosses one; those that span ``least`` words or more."""

    def long_enough(at: np.ndarray, hub_at: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        last = ends - 1
        rise = hub_at[last] - hub_at[begins]
        return (at[last] - at[begins] >= least) & ((last - begins > 1) | ((rise > 0) & (rise <= reach)))

    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        ids, hubs, at, hub_at = (batch[name].to_numpy() for name in ("id", "hub", "at", "hub_at"))
        new = (ids[1:] != ids[:-1]) | (hubs[1:] != hubs[:-1]) | (at[1:] - at[:-1] > reach)
        begins = np.append(0, np.flatnonzero(new) + 1)
        whole, ends = begins[:-1], begins[1:]
        kept = long_enough(at, hub_at, whole, ends)
        for begin, end in zip(whole[kept], ends[kept]):
            yield batch.iloc[begin:end]
        rest = batch.iloc[begins[-1] :].reset_index(drop=True)
    if rest is not None and long_enough(rest["at"].to_numpy(), rest["hub_at"].to_numpy(), np.array([0]), np.array([len(rest)]))[0]:
        yield rest


def wanted_runs(shared: np.ndarray, size: int, width: int, window: int, long: int) -> np.ndarray:
    """Starts of the runs of ``long`` words in which every window of seeds has a shared one, in a text of ``size`` words."""
    at = np.unique(shared)
    cuts = np.flatnonzero(np.diff(at) > window) + 1
    out = np.zeros(max(0, size - long + 1), bool)
    for first, last in zip(at[np.append(0, cuts)], at[np.append(cuts - 1, len(at) - 1)]):
        out[max(0, first - window + 1) : max(0, last + window + width - long)] = True
    return np.flatnonzero(out)


def outside(at: np.ndarray, long: int, begins: np.ndarray | None, ends: np.ndarray | None) -> np.ndarray:
    """Which of the runs of ``long`` words that start there lie in no passage."""
    if begins is None:
        return np.ones(len(at), bool)
    begins, ends = np.sort(begins), np.sort(ends)
    nth = np.searchsorted(begins, at, side="right") - 1
    return (nth < 0) | (at + long > ends[nth])


@small_batches
def repeated_passages(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, window: int = 12,
    more_than: int = 50, least_chain: int = 20, gap: float = 0.1, reach: int = 64, identity: float = 0.8,
) -> DataFrame:
    """Passages of more than ``more_than`` words that other documents repeat, exactly or nearly:
    ``id_col, start, end, n_words, with_id, identity``.

    Seeds are runs of ``width`` words in lower case, thinned to the smallest of every ``window``. All places of a seed
    are joined to its first place (smallest document, then position), so a passage in thousands of documents gives a
    match per place and not per pair; where a text repeats a seed, its n-th place also meets the first n-th place. The matches of two documents are chained with gap costs by a Fenwick tree; a
    chain of ``least_chain`` words or more is extended into the words around it and aligned, and stays if its share
    of equal words reaches ``identity``. Aligned stretches of a document that overlap or touch are one passage.
    ``start`` and ``end`` are code points, ``with_id`` is the smallest other document of its stretches, ``identity``
    their smallest share.

    Seeds with scattered first places give no chain that is long enough. Therefore every run of ``least_chain`` words
    (all positions, not thinned) that other documents repeat and that lies in no passage so far is joined again, to the
    first place of the whole run, or to its last one from inside the first document; runs that continue each other are
    one chain. Of the runs inside passages only those that hold seeds of such runs are looked at, as only they can equal one. As each such run is a chain of its own, every word of an exact repeat is found, whatever its seeds met.

    Texts are shuffled for documents with chains only. Rows with texts and words go to Python in batches of about 4 MB; the
    passages are written to the shared folder, as all stages before them. Null and empty texts have no passages, null ids take no part,
    of rows that repeat an id the smallest text counts, repeats inside one document do not, an empty table gives no
    rows. Other columns are not read.
    """
    texts = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )

    again = cut_lineage(texts.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "again")
    repeated = texts.join(again, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    texts = texts.join(again, "id", "left_anti").unionByName(repeated)

    def find_seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for some in chunks(batch["text"]):
                hashes, part, at, first = seeds(batch["text"].iloc[some], width, window)
                ids = batch["id"].to_numpy()[some][part]
                yield pd.DataFrame({"seed": hashes.view(np.int64), "id": ids, "at": at, "first": first})

    places = cut_lineage(texts.mapInPandas(find_seeds, "seed long, id long, at int, first boolean"), "seeds")
    first = places.where("first").groupBy("seed").agg(
        F.min("id").alias("hub"), F.min_by("at", "id").alias("hub_at"), F.max("id").alias("last")
    )
    first = cut_lineage(first.where("hub < last").drop("last"), "hubs")
    met = cut_lineage(places.drop("first").join(first, "seed").select("seed", "id", "hub", "at", "hub_at"), "met")
    drop_written(places, first)
    matches = met.where("id > hub").drop("seed").repartition("id").sortWithinPartitions("id", "hub", "at")

    def chained_matches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for group in near_matches(batches, max(least_chain - width, 1), reach):
            own, hub = int(group["id"].iloc[0]), int(group["hub"].iloc[0])
            for found in chains(group["at"].to_numpy(), group["hub_at"].to_numpy(), width, gap, least_chain, reach):
                (x, y), (x_end, y_end) = found[0], found[-1]
                out.append((own, hub, x, y, x_end + width, y_end + width))
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=columns)
                out = []
        yield pd.DataFrame(out, columns=columns)

    columns, kind = ["id", "hub", "x", "y", "x_end", "y_end"], "id long, hub long, x int, y int, x_end int, y_end int"
    chained = matches.mapInPandas(chained_matches, kind)
    chained = cut_lineage(chained, "chains")
    long = max(least_chain, width + window - 1)

    def dense(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for begin in range(0, len(whole), 1000):  # a copy of few arrays at a time
                batch = whole.iloc[begin : begin + 1000]
                # whatever the text's length, some run of the needed length has to lie between the shared places
                sizes = [int(max(at)) + width + window - 1 for at in batch["shared"]]
                yield batch[[len(wanted_runs(at, size, width, window, long)) > 0 for at, size in zip(batch["shared"], sizes)]]

    met_written, met = met, met.select("seed", "id", "at")
    shared = met.groupBy("id").agg(F.collect_list("at").alias("shared"), F.collect_list("seed").alias("seeds"))
    shared = cut_lineage(shared.mapInPandas(dense, "id long, shared array<int>, seeds array<long>"), "shared")
    in_chains = chained.select("id").unionAll(chained.select("hub")).select("id", F.lit(True).alias("chained"))
    used = in_chains.unionAll(shared.select("id", F.lit(False))).groupBy("id").agg(F.max("chained").alias("chained"))
    used = cut_lineage(texts.join(used, "id"), "texts")

    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, words = None, None
        for batch in batches:
            out = []
            for text, a, b in zip(batch.pop("text"), batch.pop("from"), batch.pop("to")):
                if text is not known and text != known:
                    known, words = text, word_hashes(text)
                out.append(words[max(0, a - MARGIN) : b + MARGIN].tobytes())
            batch["words"] = out
            yield batch

    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            one, two = ([np.frombuffer(words, np.uint64) for words in batch[side]] for side in ("own", "other"))
            own, hub, x, y, x_end, y_end = (batch[name].to_numpy().astype(np.int64) for name in columns)
            before, hub_before = x - np.minimum(x, MARGIN), y - np.minimum(y, MARGIN)  # words left of the slices
            bare = x - before, x_end - before, y - hub_before, y_end - hub_before
            *wide, share = align(one, two, bare[0], bare[2], bare[1], bare[3])
            low = share < identity  # the chain without the words around it
            a, b, c, d = (np.where(low, inner, outer) for inner, outer in zip(bare, wide))
            for i in np.flatnonzero(low):
                share[i] = common(one[i][a[i] : b[i]], two[i][c[i] : d[i]]) / max(b[i] - a[i], d[i] - c[i])
            sides = [(own, hub, before + a, before + b, share), (hub, own, hub_before + c, hub_before + d, share)]
            kept = [[values[share >= identity] for values in side] for side in sides]
            yield pd.DataFrame({
                name: np.concatenate(values) for name, values in zip(["id", "other", "from", "to", "share"], zip(*kept))
            })

    def stretches_of(chained: DataFrame, used: DataFrame) -> DataFrame:
        def side(doc: str, begin: str, end: str, first: bool) -> DataFrame:
            return chained.select(*columns, F.col(doc).alias("doc"), F.col(begin).alias("from"), F.col(end).alias("to"), F.lit(first).alias("first"))

        # the words of both sides by one shuffle of the texts
        sides = side("id", "x", "x_end", True).unionAll(side("hub", "y", "y_end", False))
        sides = sides.join(used.select(F.col("id").alias("doc"), "text"), "doc").select(*columns, "first", "from", "to", "text")
        sides = sides.mapInPandas(slices, f"{kind}, first boolean, words binary")
        sides = sides.groupBy(*columns).agg(
            F.max(F.when(F.col("first"), F.col("words"))).alias("own"), F.max(F.when(~F.col("first"), F.col("words"))).alias("other")
        )
        found = sides.mapInPandas(aligned, "id long, other long, from int, to int, share double")
        # at most a row per position of a document, however many documents share it
        found = found.groupBy("id", "from").agg(F.max("to").alias("to"), F.min("other").alias("other"), F.min("share").alias("share"))
        return cut_lineage(found, "stretches")

    def passages_of(stretches: DataFrame) -> DataFrame:
        order = Window.partitionBy("id").orderBy("from")
        before = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
        stretches = stretches.withColumn("new", (before.isNull() | (F.col("from") > before)).cast("int"))
        stretches = stretches.withColumn("passage", F.sum("new").over(order))
        return stretches.groupBy("id", "passage").agg(
            F.min("from").alias("from"), F.max("to").alias("to"), F.min("other").alias("with_id"), F.min("share").alias("identity")
        ).where(F.col("to") - F.col("from") > more_than)

    def open_seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [np.empty(0, np.int64)]
            for at, own, begins, ends in batch[["shared", "seeds", "begins", "ends"]].itertuples(index=False):
                runs = wanted_runs(at, int(max(at)) + width + window - 1, width, window, long)
                runs = np.append(-len(at) - long, runs[outside(runs, long, begins, ends)])
                out.append(own[at - runs[np.searchsorted(runs, at, side="right") - 1] <= long - width])
            yield pd.DataFrame({"seed": np.unique(np.concatenate(out))})

    def find_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for some in chunks(batch["text"]):
                needed, places, found = [], [], []
                for own, text, shared, begins, ends in batch.iloc[some].itertuples(index=False):
                    words = text.lower().split()
                    at = wanted_runs(shared, len(words), width, window, long)
                    if not len(at):
                        continue
                    # only the words of these runs are hashed
                    edges = np.bincount(at, minlength=len(words) + 1) - np.bincount(at + long, minlength=len(words) + 1)
                    held = np.flatnonzero(np.cumsum(edges))
                    places.append(len(needed) + np.searchsorted(held, at))
                    needed += [words[i] for i in held.tolist()]
                    found.append((np.full(len(at), own), at, outside(at, long, begins, ends)))
                if found:
                    own, at, free = map(np.concatenate, zip(*found))
                    hashes = runs_of(hashes_of(needed), long)[np.concatenate(places)]
                    yield pd.DataFrame({"run": hashes.view(np.int64), "id": own, "at": at, "open": free})

    def joined_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            before = batch.shift()
            new = (batch[["id", "hub", "lead"]] != before[["id", "hub", "lead"]]).any(axis=1) | (batch["at"] - before["at"] > long)
            ends = batch["at"][np.append(new.to_numpy()[1:], True)[: len(batch)]].to_numpy()
            out = batch[new].rename(columns={"at": "x"})
            out["y"], out["x_end"] = out["x"] - out["lead"], ends + long
            out["y_end"] = out["x_end"] - out["lead"]
            yield out[columns]

    stretches = stretches_of(chained, used.where("chained"))
    spans = passages_of(stretches).groupBy("id").agg(F.collect_list("from").alias("begins"), F.collect_list("to").alias("ends"))
    spans = cut_lineage(spans, "spans")
    # Only runs outside the passages and their equals are wanted; these hold the same seeds.
    wanted = shared.join(spans, "id", "left").select("shared", "seeds", "begins", "ends").mapInPandas(open_seeds, "seed long").distinct()
    wanted = met.join(wanted, "seed", "left_semi").groupBy("id").agg(F.collect_set("at").alias("shared"))
    wanted = wanted.mapInPandas(dense, "id long, shared array<int>")
    runs = used.join(wanted, "id").join(spans, "id", "left").select("id", "text", "shared", "begins", "ends")
    runs = cut_lineage(runs.mapInPandas(find_runs, "run long, id long, at int, open boolean"), "runs")
    drop_written(met_written, shared, spans)
    ends = runs.groupBy("run").agg(
        F.min(F.struct("id", "at")).alias("first"), F.max(F.struct("id", "at")).alias("last"), F.max("open").alias("any")
    ).where(F.col("any") & (F.col("first.id") < F.col("last.id"))).drop("any")
    partner = F.when(F.col("id") > F.col("first.id"), F.col("first")).otherwise(F.col("last"))
    again = runs.where("open").join(ends, "run").select("id", "at", partner.alias("to"))
    again = again.select("id", "at", F.col("to.id").alias("hub"), (F.col("at") - F.col("to.at")).alias("lead"))
    again = again.repartition("id").sortWithinPartitions("id", "hub", "lead", "at")
    again = again.mapInPandas(joined_runs, kind)
    more = stretches_of(cut_lineage(again, "run-chains"), used)
    stretches = stretches.unionByName(more).groupBy("id", "from").agg(
        F.max("to").alias("to"), F.min("other").alias("other"), F.min("share").alias("share")
    )
    passages = cut_lineage(passages_of(stretches), "passages")

    def located(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, begins, ends = None, None, None
        for batch in batches:
            start, end = [], []
            for text, a, b in zip(batch.pop("text"), batch["from"], batch["to"]):
                if text is not known and text != known:
                    known, (begins, ends) = text, word_bounds(text)
                start.append(begins[a])
                end.append(ends[b - 1])
            yield batch.assign(start=start, end=end)[["id", "start", "end", "from", "to", "with_id", "identity"]]

    located_as = "id long, start long, end long, from int, to int, with_id long, identity double"
    out = passages.drop("passage").join(used.drop("chained"), "id").mapInPandas(located, located_as)
    return cut_lineage(out.select(
        F.col("id").alias(id_col), "start", "end", (F.col("to") - F.col("from")).cast("long").alias("n_words"), "with_id", "identity"
    ), "located")
