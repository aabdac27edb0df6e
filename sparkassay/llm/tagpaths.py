"""Main text of web pages by tag-path ratios: text and punctuation per root-to-leaf path, smoothed, fused, cut."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by what they do to the text. All others that are not inline open and close a block.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NEVER = set(
    "head script style noscript template nav footer aside form button select option textarea iframe object svg canvas "
    "audio video map dialog menu title".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "p": {"p"},
}
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: Words of class and id names of what is not the article.
HINTS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "sidebar footer header masthead topbar cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
    "subscription signup share sharing social comment comments disqus respond replies related recommended breadcrumb "
    "breadcrumbs pagination pager login search widget toolbar skip".split()
)
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？،؛।]")


class Blocks(HTMLParser):
    """Text blocks of a page in order, each with its tag path, its flags and how much of it is link text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, bool]] = []  # tag, left out, inside the main container
        self.blocks: list[tuple[str, str, bool, bool, int]] = []
        self.parts: list[str] = []
        self.link, self.linked = 0, 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            out, main = (self.stack[-1][1], self.stack[-1][2]) if self.stack else (False, False)
            self.blocks.append(("/".join(tag for tag, _, _ in self.stack), text, out, main, self.linked))
        self.parts, self.linked, self.link = [], 0, 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in INLINE:
            self.link += tag == "a"
            if tag in ("img", "wbr"):
                return
            return
        if tag in VOID:
            self.parts.append(" ")
            if tag == "hr":
                self.flush()
            return
        self.flush()
        closes = CLOSES.get(tag, {"p"})
        while self.stack and self.stack[-1][0] in closes:
            self.stack.pop()
        named = {name: (value or "") for name, value in attrs}
        above_out, above_main = (self.stack[-1][1], self.stack[-1][2]) if self.stack else (False, False)
        words = set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{named.get('class', '')} {named.get('id', '')}").lower()))
        role = named.get("role", "").lower()
        main = tag in ("article", "main") or role in ("main", "article") or named.get("itemprop") == "articleBody"
        hinted = bool(words & HINTS) and tag not in ("html", "body", "main") and not (tag == "article" and "comment" not in words)
        hidden = "hidden" in named or named.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", named.get("style", ""))
        out = above_out or tag in NEVER or hinted or role in ROLES or bool(hidden) or (tag == "header" and not above_main)
        self.stack.append((tag, out, (above_main or main) and not out))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in VOID or tag in INLINE:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in INLINE:
            self.link = max(0, self.link - (tag == "a"))
            return
        if tag in VOID:
            self.parts.append(" ")
            return
        self.flush()
        at = next((at for at in range(len(self.stack) - 1, -1, -1) if self.stack[at][0] == tag), None)
        if at is not None:
            del self.stack[at:]

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if self.link:
            self.linked += len("".join(data.split()))


def main_blocks(html: str | None, width: float = 1.5, share: float = 0.1) -> list[str]:
    """The blocks of the article in page order.

    Blocks that an element, role or class name marks as something else are left out. The rest is grouped by tag path:
    characters outside links and punctuation marks per block give two ratios, both are smoothed along the page by a
    Gaussian, and their product, summed up per path, is kept where it reaches ``share`` of the best path. Paths inside
    an article or main element count as content unless they are mostly links.
    """
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    blocks = [block for block in parser.blocks if not block[2]]
    if any(main for _, _, _, main, _ in blocks):
        blocks = [block for block in blocks if block[3]]
    if not blocks:
        return []
    size = np.array([float(len(text)) for _, text, _, _, _ in blocks])
    plain = np.maximum(size - [linked for *_, linked in blocks], 0.0)
    marks = np.array([float(len(PUNCTUATION.findall(text))) for _, text, _, _, _ in blocks])
    paths = defaultdict(list)
    for at, (path, *_) in enumerate(blocks):
        paths[path].append(at)
    text_ratio, mark_ratio = np.zeros(len(blocks)), np.zeros(len(blocks))
    for own in paths.values():
        text_ratio[own], mark_ratio[own] = plain[own].mean(), marks[own].mean()
    reach = int(3 * width)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / width) ** 2)
    norm = np.convolve(np.ones(len(blocks)), kernel, mode="full")[reach:-reach]
    smooth = lambda x: np.convolve(x, kernel, mode="full")[reach:-reach] / norm
    fused = smooth(text_ratio) * (1.0 + smooth(mark_ratio))
    score = {path: fused[own].mean() for path, own in paths.items()}
    best = max(score.values())
    kept = set()
    for path, own in paths.items():
        text = plain[own].sum() / max(size[own].sum(), 1.0) > 0.4
        if text and (blocks[own[0]][3] or score[path] >= share * best):
            kept.update(own)
    return [blocks[at][1] for at in sorted(kept)]


def extract_main_text(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """``id_col, url_col, text``: the blocks of each page's article, joined by two line breaks.

    Character references are decoded, white space inside a block becomes one space. Nothing is cut from a block and no
    block is cut by its length. Pages are independent of each other, so nothing is shuffled.

    A null or empty page and one without an article give an empty text. Null or repeated ids are pages of their own.
    Unclosed elements end with the element around them. An empty table gives no rows. Other columns are not read.
    """
    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["text"] = ["\n\n".join(main_blocks(html)) for html in batch.pop("html")]
            yield batch

    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).cast("string").alias("html"))
    return rows.mapInPandas(extract, rows.drop("html").schema.add("text", "string"))
