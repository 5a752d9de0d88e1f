"""Main text of web pages: a linear-chain CRF over the leaf blocks of the document tree.

A page is cut into blocks of running text at the boundaries of block elements. A block is
described by its ancestors (tags, words of class, id and role) and its text (length,
links, punctuation, place on the page). The chain has two labels, article and rest; it is
trained by gradient ascent on labelled pages and decoded by Viterbi.

Labels come from the pages themselves: the element that marks the article up says what is
article. The blocks of these pages are also laid out anew, in other frames with menus,
notices, comments and so on, so that the model does not hang on one layout or one tag.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.text import slices

CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
    "nav ol p pre section table ul figure".split()
)
# Left open, these end at the next block tag; script and the like are read to the end of the page.
ENDS = "|".join(sorted(CLOSES_P | frozenset("li dt dd tr td th body".split())))
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>"
    r"|<(?P<raw>script|style|iframe|textarea|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|(?P<empty><svg\b[^>]*/>)"
    r"|<(?P<part>noscript|template|svg|select)\b[^>]*>"
    rf"(?:(?:(?!<(?P=part)\b).)*?</(?P=part)\s*>|(?:(?!</?(?:{ENDS})\b).)*)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_WORD = re.compile(r"[a-z]+")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rt rp s "
    "samp small span strike strong sub sup time tt u var wbr img label button input".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SAME = frozenset("li dt dd tr td th option".split())
SPACES = re.compile(r"\s+")


@dataclass
class Block:
    """Text of a block, its characters inside links, and the elements around it."""

    text: str
    linked: int
    path: tuple[tuple[str, str], ...]


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order; character references decoded, white space single."""
    found: list[Block] = []
    stack: list[tuple[str, str]] = []
    held: list[str] = []
    linked, links, at = 0, 0, 0
    path: tuple | None = ()

    def flush() -> None:
        nonlocal linked
        if held:
            text = SPACES.sub(" ", html.unescape("".join(held))).strip()
            if text:
                found.append(Block(text, linked, path))
            held.clear()
        linked = 0

    for mark in MARKUP.finditer(page):
        if mark.start() > at:
            if not held:
                path = tuple(stack)
            held.append(page[at : mark.start()])
            if links:
                linked += mark.start() - at
        at = mark.end()
        tag = mark["tag"]
        if not tag:
            if mark["empty"] or mark["part"] or mark["raw"] and mark["raw"].lower() != "title":
                held.append(" ") if held else None
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if not inline:
            flush()
        if tag == "a":
            links = 0 if mark["close"] else 1
        if mark["close"]:
            names = [t for t, _ in stack]
            if tag in names:
                del stack[len(names) - 1 - names[::-1].index(tag) :]
        elif tag not in VOID and not mark["rest"].endswith("/") and not inline:
            if tag in CLOSES_P:
                while stack and stack[-1][0] == "p":
                    stack.pop()
            if tag in SAME and stack and stack[-1][0] == tag:
                stack.pop()
            named = " ".join(next(filter(None, m.groups()), "") for m in NAMED.finditer(mark["rest"]))
            stack.append((tag, named.lower()))
    if at < len(page):
        if not held:
            path = tuple(stack)
        held.append(page[at:])
    flush()
    return found


def path_features(path: tuple[tuple[str, str], ...]) -> list[str]:
    """Tags and name words of the ancestors, the nearest tag, and tags in their order."""
    found = {f"in:{tag}" for tag, _ in path}
    found |= {f"name:{w}" for _, named in path for w in NAME_WORD.findall(named)}
    near = [tag for tag, _ in path[-2:]]
    if not any(named for _, named in path):
        found.add("bare:" + ">".join(tag for tag, _ in path[-4:]))
    return sorted(found) + [f"own:{''.join(near[-1:])}", f"pair:{'>'.join(near)}"]


def text_features(block: Block, at: int, total: int) -> list[str]:
    text = block.text
    words = text.count(" ") + 1
    found = [
        f"words:{min(7, words.bit_length())}",
        f"links:{min(4, 4 * block.linked // len(text))}",
        f"stops:{min(3, text.count('. ') + text.count(', '))}",
        f"ends:{text[-1] in '.!?…。！？\"”'}",
        f"place:{4 * at // total}",
        "always",
    ]
    if "©" in text or "·" in text:
        found.append("mark")
    return found


@dataclass
class Model:
    """Scores of article less rest: of each feature, and of the four label pairs."""

    weights: dict[str, float] = field(default_factory=dict)
    pairs: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def scores(self, page: list[Block], paths: dict) -> list[float]:
        get, out = self.weights.get, []
        for at, block in enumerate(page):
            known = paths.get(block.path)
            if known is None:
                if len(paths) > 50_000:
                    paths.clear()
                known = paths[block.path] = sum(get(f, 0.0) for f in path_features(block.path))
            out.append(known + sum(get(f, 0.0) for f in text_features(block, at, len(page))))
        return out

    def labels(self, scores: list[float]) -> list[bool]:
        """Viterbi over rest (0) and article (1)."""
        if not scores:
            return []
        (p00, p01), (p10, p11) = self.pairs.tolist()
        zero, one, back = 0.0, scores[0], []
        for score in scores[1:]:
            from_one = (one + p10 > zero + p00, one + p11 >= zero + p01)
            zero, one = (
                max(zero + p00, one + p10),
                max(zero + p01, one + p11) + score,
            )
            back.append(from_one)
        label = one >= zero
        out = [label]
        for from_one in reversed(back):
            label = from_one[label]
            out.append(label)
        return out[::-1]


def fit(pages: list[tuple[list[Block], list[bool]]], steps: int = 200, decay: float = 2e-4) -> Model:
    """Maximises the likelihood of the labels (less a small penalty) by Adam."""
    pages = [(p, y) for p, y in pages if p]
    if not pages:
        return Model()
    names: dict[str, int] = {}
    cells, owner, n = [], [], 0
    for page, _ in pages:
        for at, block in enumerate(page):
            for f in path_features(block.path) + text_features(block, at, len(page)):
                cells.append(names.setdefault(f, len(names)))
                owner.append(n)
            n += 1
    cells, owner = np.array(cells), np.array(owner)
    longest = max(len(p) for p, _ in pages)
    place = np.full((len(pages), longest), -1)
    truth = np.zeros((len(pages), longest), int)
    n = 0
    for row, (page, labels) in enumerate(pages):
        place[row, : len(page)] = np.arange(n, n + len(page))
        truth[row, : len(page)] = labels
        n += len(page)
    inside = place >= 0
    follows = inside[:, 1:]
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (truth[:, :-1][follows], truth[:, 1:][follows]), 1)
    w = np.zeros(len(names) + 4)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        score = np.bincount(owner, w[cells], n)
        pairs = w[-4:].reshape(2, 2)
        local = np.zeros((*place.shape, 2))
        local[..., 1][inside] = score[place[inside]]
        ahead, behind = np.zeros_like(local), np.zeros_like(local)
        ahead[:, 0] = local[:, 0]
        for t in range(1, longest):
            moved = np.logaddexp.reduce(ahead[:, t - 1, :, None] + pairs, axis=1) + local[:, t]
            ahead[:, t] = np.where(inside[:, t, None], moved, ahead[:, t - 1])
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        for t in range(longest - 2, -1, -1):
            moved = np.logaddexp.reduce(pairs + (local[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(inside[:, t + 1, None], moved, 0)
        chance = np.exp(ahead + behind - total[:, None, None])[..., 1]
        both = np.exp(
            ahead[:, :-1, :, None] + pairs + (local + behind)[:, 1:, None, :] - total[:, None, None, None]
        )[follows].sum(0)
        error = np.zeros(n)
        error[place[inside]] = (truth - chance)[inside]
        gradient = np.concatenate(
            [np.bincount(cells, error[owner], len(names)), (seen_pairs - both).ravel()]
        ) / len(pages) - decay * w
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        w += 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model({f: float(w[i]) for f, i in names.items()}, w[-4:].reshape(2, 2).copy())


# Parts of a page that are not its article: fixed layouts whose {} take other pages' words.
REST = [
    '<nav><ul><li><a href="#">{}</a></li><li><a href="#">{}</a></li><li><a href="#">{}</a></li></ul></nav>',
    '<div class="menu navbar"><a href="#">{}</a> <a href="#">{}</a> <a href="#">{}</a></div>',
    '<header class="site-header"><h2>{}</h2><p>{}</p></header>',
    '<div id="header" role="banner"><span>{}</span></div>',
    '<div class="breadcrumb"><a href="#">{}</a> &gt; <a href="#">{}</a></div>',
    '<aside class="sidebar"><h3>{}</h3><p>{s}</p><ul><li><a href="#">{}</a></li></ul></aside>',
    '<div id="sidebar" class="widget"><h4>{}</h4><p>{s}</p></div>',
    '<div class="ad advert">{s}</div>',
    '<div class="ads sponsored promo"><p>{s}</p></div>',
    '<div class="cookie-notice banner"><p>{s}</p><button>{}</button></div>',
    '<div id="consent" role="dialog"><p>{s}</p></div>',
    '<form class="newsletter subscribe"><label>{}</label><p>{s}</p><input type="text"><button>{}</button></form>',
    '<form action="/search"><p>{}</p></form>',
    '<div class="share social"><a href="#">{}</a><a href="#">{}</a></div>',
    '<section class="related"><h3>{}</h3><ul><li><a href="#">{}</a></li><li><a href="#">{}</a></li></ul></section>',
    '<section class="comments" id="comments"><h3>{}</h3><div class="comment"><p>{s}</p></div><div class="comment"><p>{s}</p></div></section>',
    '<div class="comment-list"><article class="comment"><p>{s}</p></article><ol><li class="reply"><p>{s}</p></li></ol></div>',
    '<div class="alert notice"><p>{s}</p></div>',
    '<footer><p>&copy; {}</p><p>{s}</p></footer>',
    '<div id="footer" class="copyright legal"><p>&copy; {} &middot; {s}</p></div>',
]
FRAMES = [
    "<article>{}</article>",
    "<main>{}</main>",
    '<main role="main"><article class="post">{}</article></main>',
    '<div id="content" class="article-body">{}</div>',
    '<div class="post-content entry">{}</div>',
    '<section class="story"><div class="text">{}</div></section>',
    "<div><div>{}</div></div>",
    "<table><tr><td>{}</td></tr></table>",
]
PARTS = ["<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<div>{}</div>", "<blockquote><p>{}</p></blockquote>", "<ul><li>{}</li></ul>", "<h2>{}</h2>", "<pre>{}</pre>"]
ARTICLE = "data-article"


def own_labels(page: str) -> tuple[list[Block], list[bool]] | None:
    """Blocks of a page that marks its article up, and whether they are inside."""
    found = blocks(page)
    inside = [any(tag == "article" for tag, _ in b.path) for b in found]
    return (found, inside) if any(inside) and not all(inside) else None


def laid_out_anew(texts: list[str], rest: list[str], seed: int) -> tuple[list[Block], list[bool]]:
    """A labelled page in another layout: article ``texts`` in a frame, other parts around it.

    Labels are told by a class word that is taken off again before training.
    """
    roll = np.random.default_rng(seed)
    pick = lambda options: options[roll.integers(len(options))]

    def part() -> str:
        layout = pick(REST)
        while "{" in layout:
            filler = pick(rest)
            if roll.random() < 0.5 or "{s}" not in layout[: layout.find("}") + 1]:
                filler = " ".join(filler.split()[: roll.integers(1, 5)]) if layout[layout.find("{") + 1] == "}" else filler
            at = layout.find("{")
            layout = layout[:at] + html.escape(filler) + layout[layout.find("}", at) + 1 :]
        return layout

    body = f"<h1>{html.escape(texts[0])}</h1>" + "".join(
        pick(PARTS).replace("{}", html.escape(t)) for t in texts[1:]
    )
    inner = part() if roll.random() < 0.3 else ""
    before = "".join(part() for _ in range(roll.integers(1, 5)))
    after = "".join(part() for _ in range(roll.integers(1, 5)))
    page = before + pick(FRAMES).replace("{}", f'<div id="{ARTICLE}">{body}</div>{inner}') + after
    found = blocks(page)
    mark = ("div", ARTICLE)
    labels = [mark in b.path for b in found]
    return [Block(b.text, b.linked, tuple(p for p in b.path if p != mark)) for b in found], labels


def labelled(pages: list[str], copies: int = 2) -> list[tuple[list[Block], list[bool]]]:
    """Training pages: those that mark their article up, each also in ``copies`` other layouts."""
    known = [found for found in map(own_labels, pages) if found]
    rest = [b.text for found, inside in known for b, i in zip(found, inside) if not i] or ["menu", "all rights reserved"]
    articles = [[b.text for b, i in zip(found, inside) if i] for found, inside in known]
    loose = rest + [t for texts in articles for t in texts[1:2]]
    again = [
        laid_out_anew(texts[:40], loose, 1000 * at + copy)
        for at, texts in enumerate(articles)
        for copy in range(copies)
    ]
    return known + again


def train(pages: DataFrame, sample_pages: int = 200) -> Model:
    """A model from ``sample_pages`` pages at most that mark their article up.

    The pages are those of the smallest hashes of their markup. Hashes are drawn among
    different ones, so a page that repeats however often counts once, and only the pages
    of the drawn hashes are gathered. Without any such page every block counts as article.
    """
    marked = pages.where(F.lower("html").contains("<article")).select(
        "html", F.xxhash64("html").alias("hash")
    )
    drawn = [row["hash"] for row in marked.select("hash").distinct().orderBy("hash").limit(sample_pages).collect()]
    last = drawn[-1] if drawn else 0
    chosen = marked.where(F.col("hash") <= last).distinct().orderBy("hash", "html").limit(sample_pages)
    return fit(labelled([row["html"] for row in chosen.collect()]))


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, url, text) for every row of ``pages``: the article's blocks, blank-joined.

    A missing or empty page, and one without article, has the text ''. Repeated rows and
    rows without page_id are handled like any other; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths: dict = {}
        for batch in batches:
            for first, texts in slices(batch.column("html")):
                out = []
                for page in texts:
                    found = blocks(page)
                    kept = model.labels(model.scores(found, paths))
                    out.append(" ".join(b.text for b, k in zip(found, kept) if k))
                part = batch.slice(first, len(texts))
                yield pa.record_batch(
                    [part.column("page_id"), part.column("url"), pa.array(out, pa.string())],
                    ["page_id", "url", "text"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id bigint, url string, text string"
    )
