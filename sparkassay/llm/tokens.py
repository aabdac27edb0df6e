"""Token ids of whole texts by the tokenizers library, with a bounded memory of words already encoded.

A byte-level BPE vocabulary splits a text into words before it merges, and a space opens a new word unless white
space stands on both sides of it. Texts are therefore cut at spaces, each distinct piece is encoded once per Python
worker and the ids are put together. A new piece that opens with Latin letters is cut once more behind them, as
letters never join what follows them, so a word is encoded once whatever stands after it. Texts where the cut could differ (white space around a space, the strings of
special tokens) and vocabularies of another kind are encoded whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sparkassay.llm.common import worker_state

#: Pieces remembered per Python worker (about 200 MB); more are encoded again, never skipped.
REMEMBERED = 1_000_000
#: Latin letters that open a piece, if an ASCII character that is no letter (or nothing) follows.
HEAD = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+(?=[\\x00-@\\[-`{-\\x7f]|\\Z)")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            kind = json.load(file)
        split = kind.get("pre_tokenizer") or {}
        self.by_piece = (
            split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
            and not kind.get("normalizer") and not kind.get("post_processor") and not kind.get("truncation")
            and not kind.get("padding")
        )
        self.special = [token["content"] for token in kind.get("added_tokens", [])]
        self.known: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # ids of tokens that open with a space
        self.spaced[[number for token, number in vocabulary.items() if token.startswith("\u0120")]] = True

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(one.ids, "<u4").tobytes() for one in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_piece:
            return self.whole(texts)
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        words = cut.flatten().dictionary_encode()
        ids = self.pieces(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat, places = np.frombuffer(b"".join(ids), "<u4"), words.indices.to_numpy()
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        ends, bounds = np.cumsum(sizes)[places], cut.offsets.to_numpy()
        sizes = sizes[places]
        unsure = sizes == 0
        unsure[bounds[:-1]] = False
        unsure = np.logical_or.reduceat(unsure, bounds[:-1]).tolist()
        sizes[bounds[:-1]] = 0  # the first piece of a text follows no space
        stops = np.cumsum(sizes)
        shifts, stops, bounds = ends - stops, np.append(0, stops)[bounds].tolist(), bounds.tolist()
        firsts = self.whole([text.partition(" ")[0] for text in texts])
        out = []
        for at, (text, first) in enumerate(zip(texts, firsts)):
            if unsure[at] or any(token in text for token in self.special):
                out.append(self.whole([text])[0])
            else:
                own = slice(bounds[at], bounds[at + 1])
                from_flat = np.repeat(shifts[own], sizes[own]) + np.arange(stops[at], stops[at + 1])
                out.append(first + flat[from_flat].tobytes())
        return out

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that follow a space; none where the cut before them may be wrong."""
        known, tails = self.known, self.tails
        found = list(map(known.get, pieces))
        gaps = [at for at, have in enumerate(found) if have is None]
        heads = [match[0] if (match := HEAD.match(pieces[at])) else pieces[at] for at in gaps]
        rests = [pieces[at][len(head) :] for at, head in zip(gaps, heads)]
        fresh = self.after_space(list({head for head in heads if head not in known}))
        new = list({rest for rest in rests if rest not in tails})
        ends = dict(zip(new, self.whole(new)))
        for at, head, rest in zip(gaps, heads, rests):
            ids = fresh.get(head)
            ids = known[head] if ids is None else ids
            if rest:
                ids += tails[rest] if rest in tails else ends[rest]
            found[at] = ids
        if len(known) + len(tails) < self.remembered:
            known.update(fresh)
            known.update((pieces[at], found[at]) for at in gaps)
            tails.update(ends)
        return found

    def after_space(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of distinct pieces, put behind a space each; none for those that are empty or open with white space."""
        out = {piece: b"" for piece in pieces if not piece or piece[0].isspace()}
        pieces = [piece for piece in pieces if piece not in out]
        for at in range(0, len(pieces), 2_000):
            some = pieces[at : at + 2_000]
            ids = np.frombuffer(self.whole([" " + " ".join(some)])[0], "<u4")
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) == len(some):
                flat, cuts = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
                out.update((piece, flat[start:stop]) for piece, start, stop in zip(some, cuts, cuts[1:]))
            else:
                out.update(zip(some, self.whole([f" {piece}" for piece in some])))
        return out


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """The worker's encoder for a vocabulary file, remembering at most ``remembered`` pieces."""
    return worker_state(f"encoder:{path}:{remembered}", lambda: Encoder(path, remembered))
