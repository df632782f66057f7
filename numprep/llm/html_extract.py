"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM, decoded by Viterbi."""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numprep.llm.common import ship

#: Pages of the table that the field is trained on, those with the least hash of their key.
SAMPLE_PAGES = 160
#: Steps of the training, its step length, and the weight of the squared parameters.
STEPS, RATE, PENALTY = 120, 0.5, 1e-4

_BLOCKS = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
    select summary table tbody td tfoot th thead tr ul""".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
_SILENT = frozenset("script style template title textarea iframe noembed noframes".split())
#: Elements in a line of text whose content is text: of blocks of their own, which end no paragraph, or of the block they are in.
_EMBEDDED = frozenset("object audio video canvas".split())
_INLINE = frozenset("svg math".split())
#: A start tag of the key ends an open element of these names, up to one of those after the bar.
_ENDS = {
    "li": ("li", "ul ol menu dir"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "option": ("option", "select"),
}
_ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in _ENDS.items()}
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*>|[^>]*>)|<[!?/][^>]*>""", re.S)
_NAMED = re.compile(r"""(?:class|id|role|data-main)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
_TRUTH = re.compile(r"""data-main\s*=\s*"?([01])""")
_TOKEN = re.compile(r"[a-z]+")
_END_OF_SENTENCE = re.compile(r"[.!?…。][\"'”»)]?$")


@dataclass
class Block:
    """Text between two borders of block elements: where it is, how much of it is link text, and its label if known."""

    text: str
    path: tuple[str, ...]
    linked: int
    truth: int | None
    holds: tuple[str, ...] = ()


def leaf_blocks(page: str) -> list[Block]:
    """The blocks of a page that have text, in page order. Any text is a page; unclosed elements end with it."""
    blocks: list[Block] = []
    stack: list[tuple[str, str, int | None]] = []  # name, names given by attributes, label
    parts: list[str] = []
    holds: set[str] = set()
    links = linked = 0
    at, end = 0, len(page)
    # No tag ends behind the last ">", so none is sought there: a page of unclosed tags is read once.
    last = page.rfind(">") + 1

    def close() -> None:
        nonlocal parts, holds, linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                path = tuple(s[0] + s[1] for s in stack)
                truth = next((s[2] for s in reversed(stack) if s[2] is not None), None)
                blocks.append(Block(text, path, linked, truth, tuple(sorted(holds))))
            parts, linked = [], 0
        holds = set()

    while at < end:
        found = _TAG.search(page, at, last)
        if found:
            stop = found.start()
        else:
            stop = page.find("<!--", at)  # an unclosed comment hides the rest
            stop = end if stop < 0 else stop
        if stop > at:
            parts.append(page[at:stop])
            if links:
                linked += stop - at
        if not found:
            break
        at = found.end()
        name = found.group(2)
        if not name:
            if found.group().startswith("<!--") and not found.group().endswith("-->"):
                break
            continue
        name = name.lower()
        if found.group(1):
            if name == "a":
                links = max(0, links - 1)
            elif name in _BLOCKS or name in _EMBEDDED:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        close()
                        del stack[i:]
                        if name in _BLOCKS:
                            links = 0
                        break
                else:
                    close()
            continue
        if name in _SILENT:
            # "/>" does not close them: what follows is theirs up to their end tag.
            ending = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at, last)
            at = ending.end() if ending else end
            continue
        if name == "a":
            links = 1
        elif name == "br":
            parts.append(" ")
        elif name in _INLINE:
            holds.add(name)
        elif name in _BLOCKS or name in _EMBEDDED:
            close()
            if name in _BLOCKS and stack and stack[-1][0] == "p":
                stack.pop()
            if name in _ENDS:
                own, border = _ENDS[name]
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in border:
                        break
                    if stack[i][0] in own:
                        del stack[i:]
                        break
            if name not in _VOID:
                given, truth = "", None
                if len(found.group(3)) > 1:
                    values = [v.strip("\"'").lower() for v in _NAMED.findall(found.group(3))]
                    given = "".join("." + t for v in values for t in _TOKEN.findall(v))
                    labelled = _TRUTH.search(found.group(3))
                    truth = int(labelled.group(1)) if labelled else None
                stack.append((name, given, truth))
    close()
    return blocks


def _path_features(path: tuple[str, ...]) -> list[str]:
    """Names of all ancestors and of their classes, and the block's own element."""
    found = {"own:" + (path[-1].split(".")[0] if path else "none")}
    for element in path:
        name, *given = element.split(".")
        if name not in ("html", "body"):
            found.add("in:" + name)
        found.update("named:" + g for g in given)
    return sorted(found)


def _text_features(block: Block) -> list[str]:
    n = len(block.text)
    out = ["bias", f"length:{min(n.bit_length(), 9)}", f"linked:{min(4, 4 * block.linked // max(n, 1))}"]
    if _END_OF_SENTENCE.search(block.text):
        out.append("sentence")
    if "©" in block.text:
        out.append("copyright")
    return out + ["holds:" + name for name in block.holds]


def features(blocks: list[Block]) -> list[list[str]]:
    """Ancestor and text features of each block."""
    return [_path_features(b.path) + _text_features(b) for b in blocks]


@dataclass
class Field:
    """Weights for main text against other text: of features, of pairs of neighbouring labels, and of both ends."""

    weights: dict[str, float]
    pairs: np.ndarray  # from label, to label
    first: np.ndarray
    last: np.ndarray

    def __post_init__(self) -> None:
        self.memory: dict[tuple[str, ...], float] = {}

    def _score(self, block: Block) -> float:
        known = self.memory.get(block.path)
        if known is None:
            if len(self.memory) > 100_000:
                self.memory.clear()
            known = self.memory[block.path] = sum(self.weights.get(f, 0.0) for f in _path_features(block.path))
        return known + sum(self.weights.get(f, 0.0) for f in _text_features(block))

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most likely labels, by Viterbi."""
        if not blocks:
            return []
        (a, b), (c, d) = self.pairs.tolist()
        scores = [self._score(x) for x in blocks]
        other, main = float(self.first[0]), float(self.first[1]) + scores[0]
        back = []
        for score in scores[1:]:
            from_main = (main + c > other + a, main + d > other + b)
            back.append(from_main)
            other, main = max(other + a, main + c), max(other + b, main + d) + score
        label = int(main + float(self.last[1]) > other + float(self.last[0]))
        labels = [label]
        for from_main in reversed(back):
            label = int(from_main[label])
            labels.append(label)
        return labels[::-1]


def train(pages: Iterable[tuple[list[list[str]], list[int]]]) -> Field:
    """Fit the field to pages of (features of each block, its labels) by gradient ascent on their mean log-likelihood.

    Forward and backward sums run over all pages at once, one block place at a time. Same pages, same field.
    """
    pages = [(f, y) for f, y in pages if f]
    names = {name: i for i, name in enumerate(sorted({n for f, _ in pages for block in f for n in block}))}
    if not pages:
        return Field({}, np.zeros((2, 2)), np.zeros(2), np.zeros(2))
    sizes = np.array([len(f) for f, _ in pages])
    count, longest = len(pages), int(sizes.max())
    flat = np.array([names[n] for f, _ in pages for block in f for n in block])
    per_block = np.array([len(block) for f, _ in pages for block in f])
    owner = np.repeat(np.arange(len(per_block)), per_block)
    page = np.repeat(np.arange(count), sizes)
    place = np.arange(len(page)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    label = np.array([v for _, y in pages for v in y])
    inside = np.arange(longest)[None, :] < sizes[:, None]
    final = place == sizes[page] - 1
    theta = np.zeros(len(names) + 8)
    seen = np.zeros_like(theta)
    gold = np.zeros_like(theta)
    np.add.at(gold, flat, label[owner])
    tail = len(names)
    follows = np.flatnonzero(~final)
    np.add.at(gold, tail + 2 * label[follows] + label[follows + 1], 1)
    np.add.at(gold, tail + 4 + label[place == 0], 1)
    np.add.at(gold, tail + 6 + label[final], 1)
    for _ in range(STEPS):
        pairs, first, last = theta[tail : tail + 4].reshape(2, 2), theta[tail + 4 : tail + 6], theta[tail + 6 :]
        score = np.zeros((count, longest, 2))
        score[page, place, 1] = np.bincount(owner, theta[flat], minlength=len(page))
        ahead = np.zeros((count, longest, 2))
        behind = np.zeros((count, longest, 2))
        ahead[:, 0] = first + score[:, 0]
        for i in range(1, longest):
            ahead[:, i] = np.logaddexp(ahead[:, i - 1, 0, None] + pairs[0], ahead[:, i - 1, 1, None] + pairs[1]) + score[:, i]
        at_end = np.arange(longest)[None, :] == sizes[:, None] - 1
        behind[at_end] = last
        for i in range(longest - 2, -1, -1):
            further = score[:, i + 1] + behind[:, i + 1]
            step = np.logaddexp(pairs[:, 0] + further[:, 0, None], pairs[:, 1] + further[:, 1, None])
            go = i < sizes - 1
            behind[go, i] = step[go]
        total = np.logaddexp(ahead[:, 0, 0] + behind[:, 0, 0], ahead[:, 0, 1] + behind[:, 0, 1])
        likely = np.exp(np.where(inside, ahead[:, :, 1] + behind[:, :, 1] - total[:, None], -np.inf))
        expected = np.zeros_like(theta)
        expected[:tail] = np.bincount(flat, likely[page, place][owner], minlength=tail)
        if longest > 1:
            joint = (
                ahead[:, :-1, :, None] + pairs[None, None] + (score[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
            )
            joint = np.where(inside[:, 1:, None, None], joint, -np.inf)
            expected[tail : tail + 4] = np.exp(joint).sum(axis=(0, 1)).reshape(-1)
        begin, stop = likely[:, 0], likely[np.arange(count), sizes - 1]
        expected[tail + 4 :] = [count - begin.sum(), begin.sum(), count - stop.sum(), stop.sum()]
        gradient = (gold - expected) / count - PENALTY * theta
        seen += gradient**2
        theta += RATE * gradient / np.sqrt(seen + 1e-10)
    weights = {n: float(theta[i]) for n, i in names.items()}
    return Field(weights, theta[tail : tail + 4].reshape(2, 2).copy(), theta[tail + 4 : tail + 6].copy(), theta[tail + 6 :].copy())


# How parts of a page may be marked up: (element, class names). Article parts have label 1, the others 0.
_ARTICLE = [("article", ""), ("main", "content"), ("div", "article-body"), ("section", "post entry-content"), ("div", "story text")]
_OTHERS = [
    ("header", ""), ("div", "header banner"), ("nav", ""), ("div", "menu navigation"), ("ul", "breadcrumbs"),
    ("aside", ""), ("div", "sidebar widget"), ("div", "ad"), ("div", "advert sponsored promo"), ("section", "related"),
    ("div", "cookie notice"), ("div", "newsletter subscribe"), ("form", ""), ("form", "login search"),
    ("section", "comments"), ("div", "comment reply"), ("ol", "comment-list"), ("div", "share social"),
    ("footer", ""), ("div", "footer copyright"),
]


def _layout(article: list[Block], others: list[Block], draw: random.Random) -> str:
    """A page of another layout that holds the texts of a page, with its labels in the markup."""

    def some(kind: tuple[str, str], inner: str, label: int) -> str:
        name, given = kind
        marked = f' class="{given}"' if given else ""
        return f'<{name}{marked} data-main="{label}">{inner}</{name}>'

    def piece(kind: tuple[str, str]) -> str:
        texts = [draw.choice(others).text for _ in range(draw.randint(1, 4))] if others else ["more"]
        if draw.random() < 0.3 and article:
            texts.append(draw.choice(article).text)  # comments and teasers read like articles
        item = "li" if kind[0] in ("ul", "ol") else draw.choice(("p", "div", "li" if kind[0] == "nav" else "p"))
        link = draw.random() < (0.9 if kind[0] in ("nav", "ul") else 0.3)
        inner = [f'<a href="#">{entities.escape(t)}</a>' if link else entities.escape(t) for t in texts]
        return some(kind, "".join(f"<{item}>{t}</{item}>" for t in inner), 0)

    body = "".join(f"<{b.path[-1].split('.')[0] if b.path else 'p'}>{entities.escape(b.text)}</p>" for b in article)
    if draw.random() < 0.4:
        body += piece(draw.choice(_OTHERS[5:18]))
    parts = [piece(k) for k in draw.sample(_OTHERS[:13], draw.randint(0, 4))] + [some(draw.choice(_ARTICLE), body, 1)]
    parts += [piece(k) for k in draw.sample(_OTHERS[5:], draw.randint(0, 4))]
    return "<html><body>" + "".join(parts) + "</body></html>"


def labels_of(blocks: list[Block]) -> list[int]:
    """Labels of a page whose markup says them: given ones, else what is in an article but in no part of another kind."""
    other = {k for k, _ in _OTHERS} - {"ul", "ol", "div", "section"}
    classes = {c for _, given in _OTHERS for c in re.split(r"[\s-]", given) if c}

    def label(block: Block) -> int:
        if block.truth is not None:
            return block.truth
        names = [element.split(".") for element in block.path]
        within = any(n[0] in ("article", "main") for n in names)
        return int(within and not any(n[0] in other or classes & set(n[1:]) for n in names))

    return [label(b) for b in blocks]


def labelled(samples: list[str], seed: int = 11) -> Iterator[tuple[list[list[str]], list[int]]]:
    """Training pages: those of the sample that have an article and something else, and each in two further layouts."""
    draw = random.Random(seed)
    texts = [leaf_blocks(s) for s in samples]
    texts = [(b, labels_of(b)) for b in texts]
    if not any(0 < sum(y) < len(y) for _, y in texts):
        filler = "<article><h1>One</h1><p>A sentence of some words, and more.</p></article><nav><li>go</li></nav>"
        blocks = leaf_blocks(filler)
        texts.append((blocks, labels_of(blocks)))
    for blocks, labels in texts:
        if 0 < sum(labels) < len(labels):
            yield features(blocks), labels
            article = [b for b, y in zip(blocks, labels, strict=True) if y]
            others = [b for b, y in zip(blocks, labels, strict=True) if not y]
            for _ in range(2):
                again = leaf_blocks(_layout(article, others, draw))
                # Names that only the labels' own attribute brings are no features.
                yield features(again), labels_of(again)


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", sample: int = SAMPLE_PAGES) -> Field:
    """Train on at most ``sample`` pages, those with the least hash, so that the same table gives the same field."""
    hashed = pages.where(F.col(html).isNotNull()).select(F.xxhash64(key, html).alias("h"), html)
    # First the hashes alone, so that no task sends the driver pages that are not in the sample.
    last = hashed.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    chosen = hashed.where(F.col("h") <= F.lit(last)).orderBy("h").limit(sample)
    return train(list(labelled([r[html] for r in chosen.collect()])))


def main_text(field: Field, page: str | None) -> str:
    """Texts of the blocks that are main text, in page order, with one blank between."""
    blocks = leaf_blocks(page or "")
    return " ".join(b.text for b, y in zip(blocks, field.decode(blocks), strict=True) if y)


def _extracting(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(field, page) for page in batch.column("_html").to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*batch.schema.names[:-1], "text", "n_chars"],
            )

    return run


def extract(pages: DataFrame, field: Field | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: key, url, text and n_chars, its code points. A page without main text, or missing, has none.

    The field is trained here unless one is given. Pages are read whole, nothing is shuffled, and repeated rows and
    missing keys come back as they are.
    """
    ship(pages.sparkSession)
    field = field or fit(pages, key, html)
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (key, url))
    return pages.select(key, url, F.col(html).alias("_html")).mapInArrow(_extracting(field), f"{kinds}, text string, n_chars long")
