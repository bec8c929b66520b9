"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: runs of text that no block-level tag interrupts, each with
its ancestors. A block's features are its ancestors' tags and the words of their class, id
and role, and statistics of its text (length, links, punctuation, place). The field scores
blocks by these and pairs of neighbours by their labels; Viterbi gives the best labelling,
and the blocks labelled main make up the text. What a browser never shows as text (scripts,
styles, the head) is no block at all.

The field is trained on labelled pages of two kinds, both from a bounded sample of the
pages table: pages with one <article>, whose blocks inside it are main text, and pages laid
out anew from the sample's paragraphs with other markup, where every block's role is known.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import least

SAMPLE_PAGES = 200
"""Pages the field is trained on at most; as many again are laid out from their paragraphs, twice."""

SAMPLE_CHARS = 100_000
"""Longest page that may be in the sample."""

# Element names of HTML by their role in layout.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
HIDDEN_TAGS = frozenset("head title script style template noscript iframe object svg math canvas audio video".split())
# Start tags that leave an open head open.
HEAD_TAGS = frozenset("html head title meta link base basefont bgsound style script noscript noframes template".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# The open elements that a start tag ends by itself.
IMPLIED_ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
_NAME = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    ancestors: tuple[str, ...]
    names: frozenset[str]
    """Words of the class, id and role of all ancestors."""
    linked: int = 0
    """Characters inside links."""
    main: bool = False


@dataclass
class _Open:
    tag: str
    names: tuple[str, ...] = ()
    main: bool | None = None


@dataclass
class _Reader(HTMLParser):
    blocks: list[Block] = field(default_factory=list)

    def __post_init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[_Open] = []
        self.parts: list[str] = []
        self.links = self.linked = self.hidden = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            labels = [o.main for o in self.stack if o.main is not None]
            names = frozenset(n for o in self.stack for n in o.names)
            self.blocks.append(Block(text, tuple(o.tag for o in self.stack), names, self.linked, bool(labels and labels[-1])))
        self.parts, self.linked = [], 0

    def close_to(self, index: int) -> None:
        for gone in self.stack[index:]:
            self.links -= gone.tag == "a"
            self.hidden -= gone.tag in HIDDEN_TAGS
        del self.stack[index:]

    def end_head(self) -> None:
        """Close an open head: both tags that part it from the body may be left out."""
        tags = [o.tag for o in self.stack]
        if "head" in tags and not any(t in HIDDEN_TAGS and t != "head" for t in tags):
            self.close_to(tags.index("head"))

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.hidden and tag not in HEAD_TAGS:
            self.end_head()
        if tag in BLOCK_TAGS:
            self.flush()
            ends = (*IMPLIED_ENDS.get(tag, ()), "p")
            for i in range(len(self.stack) - 1, -1, -1):
                open_tag = self.stack[i].tag
                if open_tag in ends:
                    self.close_to(i)
                elif open_tag in BLOCK_TAGS:
                    break
        if tag == "body":
            self.close_to(0)  # a head that was never closed ends here
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID_TAGS:
            return
        values = {k: v or "" for k, v in attrs}
        names = tuple(_NAME.findall(" ".join(values.get(k, "") for k in ("class", "id", "role")).lower()))
        mark = values.get("data-main")
        self.stack.append(_Open(tag, names, None if mark is None else mark == "1"))
        self.links += tag == "a"
        self.hidden += tag in HIDDEN_TAGS

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in HIDDEN_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag == tag:
                if tag in BLOCK_TAGS:
                    self.flush()
                self.close_to(i)
                return
            if tag not in BLOCK_TAGS and self.stack[i].tag in BLOCK_TAGS:
                return

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Sections like <![if ...]> are passed over, whatever they name."""
        end = self.rawdata.find(">", i + 3)
        return end + 1 if end >= 0 else -1

    def handle_data(self, data: str) -> None:
        if self.hidden and self.stack[-1].tag == "head" and data.strip():
            self.end_head()
        if not self.hidden:
            self.parts.append(data)
            if self.links > 0:
                self.linked += len(data)


def blocks_of(html: str | None) -> list[Block]:
    """Leaf blocks of a page in page order; none for null or empty."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader.flush()
    return reader.blocks


def features_of(blocks: list[Block]) -> list[list[str]]:
    """Names of the features that each block has."""
    out = []
    for i, b in enumerate(blocks):
        words = b.text.split(" ")
        share = min(b.linked / len(b.text), 1.0)
        own = b.ancestors[-1] if b.ancestors else "none"
        found = {"bias", f"own={own}", f"depth={min(len(b.ancestors), 8)}"}
        found.update(f"in={t}" for t in b.ancestors)
        found.update(f"name={n}" for n in b.names)
        found.add(f"words={min(int(np.log2(len(words) + 1)), 7)}")
        found.add("links=none" if not share else "links=some" if share < 0.5 else "links=most")
        found.add(f"end={b.text[-1] if b.text[-1] in '.!?:' else 'word' if b.text[-1].isalnum() else 'other'}")
        found.add(f"stops={min(sum(b.text.count(c) for c in '.!?'), 3)}")
        found.add(f"place={int(4 * i / len(blocks))}")
        if "©" in b.text:
            found.add("copyright")
        if "|" in b.text or "»" in b.text:
            found.add("bars")
        out.append(sorted(found))
    return out


@dataclass
class Field:
    """Weights of main against other: of features, of the first block, and of neighbours by label."""

    weights: dict[str, float]
    start: float
    step: np.ndarray

    def label(self, blocks: list[Block]) -> list[bool]:
        """The best labelling of a page's blocks; of equals, the one that leaves blocks out."""
        if not blocks:
            return []
        get, step = self.weights.get, self.step.tolist()
        best, back = [0.0, self.start], []
        for t, names in enumerate(features_of(blocks)):
            score = sum(get(n, 0.0) for n in names)
            if t:
                came = [max((0, 1), key=lambda k, to=to: best[k] + step[k][to]) for to in (0, 1)]
                best = [best[came[to]] + step[came[to]][to] for to in (0, 1)]
                back.append(came)
            best[1] += score
        at = int(best[1] > best[0])
        path = [at]
        for came in reversed(back):
            at = came[at]
            path.append(at)
        return [bool(x) for x in reversed(path)]

    def main_text(self, html: str | None) -> str:
        blocks = blocks_of(html)
        return "\n".join(b.text for b, keep in zip(blocks, self.label(blocks)) if keep)


def train(pages: list[list[Block]], steps: int = 200, rate: float = 0.1, prior: float = 3.0) -> Field:
    """Maximum conditional likelihood with a normal prior, by Adam; all pages move in step.

    Forward and backward messages run over places, as arrays over pages. Features seen on
    a single page are left out. Without pages nothing is main text.
    """
    pages = [p for p in pages if p]
    if not pages:
        return Field({"bias": -1.0}, 0.0, np.zeros((2, 2)))
    named = [features_of(p) for p in pages]
    seen: dict[str, int] = {}
    for page in named:
        for name in {n for names in page for n in names}:
            seen[name] = seen.get(name, 0) + 1
    index = {name: i for i, name in enumerate(sorted(n for n, c in seen.items() if c > 1))}
    many, longest = len(pages), max(map(len, pages))
    cells, cols = [], []
    mask, truth = np.zeros((many, longest), bool), np.zeros((many, longest))
    for i, (page, features) in enumerate(zip(pages, named)):
        mask[i, : len(page)] = True
        truth[i, : len(page)] = [b.main for b in page]
        for t, names in enumerate(features):
            known = [index[n] for n in names if n in index]
            cells += [i * longest + t] * len(known)
            cols += known
    cells, cols = np.array(cells), np.array(cols)
    pair = mask[:, 1:] & mask[:, :-1]
    y = truth.astype(int)
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (y[:, :-1][pair], y[:, 1:][pair]), 1)
    d = len(index)
    theta, moment = np.zeros(d + 5), np.zeros((2, d + 5))
    for step in range(1, steps + 1):
        unary = np.bincount(cells, theta[cols], many * longest).reshape(many, longest)
        move = theta[d + 1 :].reshape(2, 2)
        score = np.stack([np.zeros_like(unary), unary], axis=2)
        score[:, 0, 1] += theta[d]
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for t in range(1, longest):
            ahead = np.logaddexp.reduce(forward[:, t - 1, :, None] + move, axis=1) + score[:, t]
            forward[:, t] = np.where(mask[:, t, None], ahead, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            behind = np.logaddexp.reduce(move + (score[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(mask[:, t + 1, None], behind, 0.0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        chance = np.exp(forward + backward - total[:, None, None])[:, :, 1] * mask
        both = forward[:, :-1, :, None] + move + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        expected = (np.exp(np.minimum(both, 0)) * pair[:, :, None, None]).sum(axis=(0, 1))
        error = (truth - chance) * mask
        gradient = np.concatenate([np.bincount(cols, error.ravel()[cells], d), [error[:, 0].sum()], (seen_pairs - expected).ravel()])
        gradient = (gradient - theta / prior**2) / many
        moment[0] = 0.9 * moment[0] + 0.1 * gradient
        moment[1] = 0.999 * moment[1] + 0.001 * gradient**2
        theta += rate * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.999**step)) + 1e-8)
    return Field({n: float(theta[i]) for n, i in index.items()}, float(theta[d]), theta[d + 1 :].reshape(2, 2))


def labelled(html_pages: list[str], layouts: int = 2, seed: int = 8) -> list[list[Block]]:
    """Training pages: those with one <article>, and new layouts of all paragraphs."""
    from tidemark.llm.layouts import Layout

    found, paragraphs = [], []
    for page in html_pages:
        blocks = blocks_of(page)
        paragraphs += [b.text for b in blocks if len(b.text) >= 40 and "p" in b.ancestors]
        if page.lower().count("<article") == 1:
            for b in blocks:
                b.main = "article" in b.ancestors
            found.append(blocks)
    for n in range(layouts * len(html_pages)):
        found.append(blocks_of(Layout(paragraphs, seed * 100_003 + n).page()))
    return found


def fit(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE_PAGES) -> Field:
    """Train on at most `sample` pages of up to `SAMPLE_CHARS` characters, chosen by a hash of their markup."""
    html = F.col(f"`{html_col}`")
    rows = pages.select(html.alias("html")).where(F.length("html").between(1, SAMPLE_CHARS))
    rows = rows.withColumn("key", F.xxhash64("html"))
    keys = [r["key"] for r in least(rows, "key", sample).collect()]
    picked = rows.where(F.col("key").isin(keys)).groupBy("key").agg(F.min("html").alias("html")).orderBy("key").collect()
    return train(labelled([r["html"] for r in picked]))


def main_texts(pages: DataFrame, model: Field, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns of every row (by default all but the markup), `text` and `n_chars`, its code points.

    Null and empty markup and pages without main text give an empty text. Repeated rows
    stay repeated; columns called like a result give way. Markup is read whole.
    """
    names = [c for c in (pages.columns if keep is None else keep) if c not in (html_col, "text", "n_chars")]
    rows = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(f"`{html_col}`").alias("html"))
    kept = rows.columns[:-1]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [model.main_text(h) for h in batch["html"]]
            yield batch[kept].assign(text=texts, n_chars=[len(t) for t in texts])

    out = rows.mapInPandas(extract, ", ".join(x for x in (schema, "text string, n_chars long") if x))
    return out.select(*[F.col(c).alias(n) for c, n in zip(kept, names)], "text", "n_chars")
