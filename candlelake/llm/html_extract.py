"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks (runs of text between block-level tags). Every block is a
vector: the hashed tags, classes and ids on its path, its hashed words, and a few measures. A
bidirectional LSTM in numpy reads the whole sequence and labels every block as main text or not, so
that a block is judged with all that stands before and after it.

Pages carry no labels. The labeller learns from weak ones: a bounded sample of the pages whose markup says
what is what (article or main against nav, aside, footer, form and telling class names). So that it
does not lean on one template, every sampled page is also read in variants, with other
containers, without some of the telling tags, and with more page furniture (comments, notices, side bars).
"""

from __future__ import annotations

import heapq
import html as entities
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import map_slices, slices

#: Bound of the sample of pages; most bytes and labelled blocks of a page that teaches (longer ones are not sampled, none is cut); widths
#: of the hashed parts and of the network.
PAGES, TEACH_BYTES, TEACH, PATH, WORDS, HIDDEN = 160, 200_000, 200, 96, 64, 16
EPOCHS, BATCH, RATE = 10, 16, 1e-2
N_MEASURES = 8
WIDTH = PATH + WORDS + N_MEASURES
#: Blocks that are read at a time; longer pages are read in stretches that carry the states over.
STRETCH = 512

# Fixed values of HTML: elements whose content is no text, elements without content, elements inside a line, and elements that end an open one.
SILENT = ("script", "style", "noscript", "template", "head", "title", "svg", "math", "canvas", "iframe", "object", "select", "textarea", "button", "audio", "video", "datalist")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
#: Block-level starts that end an open paragraph.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=(?:\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)))?)*)(?:>|\Z))", re.S)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_ATTRIBUTE = re.compile(r"([^\s/=][^\s/=]*)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s]+))?")
#: A quick look whether any attribute may hide the element, and values of style that do.
_MAY_HIDE = re.compile(r"hidden|display", re.I)
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
#: An unquoted value at the end of a tag: a slash there belongs to it.
_UNQUOTED = re.compile(r"=\s*[^\s\"'>]+\Z")
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in SILENT}
#: What telling class names, ids and roles hold.
FURNITURE = re.compile(
    r"(?:^|[\W_])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|side-?bar|aside|footer|header|masthead|cookies?|consent|notices?|alert|popup|modal|newsletter|subscribe|"
    r"comments?|replies|disqus|share|sharing|social|related|recommended|pagination|pager|login|search|widget|toolbar|copyright|legal)(?:$|[\W_])", re.I
)
APART = frozenset("nav aside footer form header menu dialog".split())


def hides(attributes: str) -> bool:
    """Whether the attributes of a tag hide its element: hidden, aria-hidden or a style without display."""
    if not _MAY_HIDE.search(attributes):
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (name == "style" and _NO_DISPLAY.search(value)):
            return True
    return False


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """(path of tags with their names, text, characters inside links) of every block with text, in page order."""
    out: list[tuple[tuple[str, ...], str, int]] = []
    stack: list[tuple[str, str, bool]] = []  # tag, tag with names, silent
    text: list[str] = []
    linked = links = silent = 0
    endless: set[str] = set()  # no end of these in the rest of the page

    def flush() -> None:
        nonlocal linked
        if text:
            words = " ".join("".join(text).split())
            if words:
                out.append((tuple(s[1] for s in stack if s[0] not in INLINE), words, linked))
            text.clear()
        linked = 0

    def pop(k: int) -> None:
        nonlocal links, silent
        for tag, _, quiet in stack[k:]:
            links -= tag == "a"
            silent -= quiet
        del stack[k:]

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        stop = m.start() if m else size
        if stop > at and not silent:
            chars = entities.unescape(page[at:stop])
            text.append(chars)
            linked += len(chars) if links > 0 else 0
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag not in INLINE:
            flush()
        if m[1]:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), -1)
            if k >= 0 and not (tag in INLINE and any(s[0] not in INLINE for s in stack[k:])):
                pop(k)
            continue
        if tag == "br":
            text.append("\n")
        if tag in VOID:
            continue
        if tag in _END:
            closed = tag in ("svg", "math") and m[3].endswith("/") and not _UNQUOTED.search(m[3])
            end = None if closed or tag in endless else _END[tag].search(page, at)
            if end:
                at = end.end()
            elif tag in ("script", "style"):
                at = size
            elif not closed:
                endless.add(tag)
            continue
        ends = CLOSES.get(tag, ()) if tag not in ENDS_P else ("p",)
        if ends:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    pop(k)
                    break
                if stack[k][0] not in INLINE and stack[k][0] not in ends:
                    break
        attributes = m[3] or ""
        names = " ".join(f"{(a[1] or a[2] or a[3]).lower()}" for a in _NAMED.findall(attributes)) if "=" in attributes else ""
        quiet = hides(attributes)
        stack.append((tag, f"{tag} {names}".strip(), quiet))
        links += tag == "a"
        silent += quiet
    flush()
    return out


def weak_label(path: tuple[str, ...]) -> int | None:
    """1 main text, 0 furniture, None where the markup does not tell."""
    tags = [p.split(" ", 1)[0] for p in path]
    if any(t in APART for t in tags) or any(" " in p and FURNITURE.search(p.split(" ", 1)[1]) for p in path):
        return 0
    return 1 if any(t in ("article", "main") for t in tags) else None


def _slot(name: str, width: int) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % width


def vectors(rows: list[tuple[tuple[str, ...], str, int]]) -> np.ndarray:
    """Blocks x WIDTH."""
    out = np.zeros((len(rows), WIDTH), np.float32)
    known: dict[tuple[str, ...], list[int]] = {}
    for k, (path, text, linked) in enumerate(rows):
        if path not in known:
            parts = [x for p in path for x in p.split()] + ([f"<{path[-1].split()[0]}"] if path else [])
            known[path] = [_slot(x, PATH) for x in parts if x not in ("html", "body")]
        out[k, known[path]] = 1
        words = set(text.lower().split(" "))
        out[k, PATH : PATH + WORDS] = np.sqrt(np.bincount([_slot(w, WORDS) for w in words], minlength=WORDS) / len(words))
        n = len(text)
        out[k, PATH + WORDS :] = (
            np.log1p(n) / 6, min(linked / n, 1), text[-1] in ".!?:\"”»…)", text.count(".") / n * 20, text.count(",") / n * 20,
            n < 40, "©" in text or "·" in text, len(path) / 8,
        )
    return out


def variants(rows: list[tuple[tuple[str, ...], str, int]], labels: list[int], g: np.random.Generator):
    """The page as other templates would mark it up: (rows, labels)."""
    yield rows, labels
    prose = [r[1] for r, y in zip(rows, labels) if y] or ["text"]
    short = [" ".join(p.split()[:12]) for p in prose]
    for _ in range(2):
        home = [str(x) for x in g.choice(["div content", "div post-body", "main", "section entry", "div article", "article", "div story", "div main", "td", "div"], 2)]
        apart = {k: str(g.choice(v)) for k, v in {"nav": ["nav", "div menu", "div navbar", "ul nav-list"], "footer": ["footer", "div footer", "div copyright"], "ad": ["div ad", "div advert", "div banner", "aside sponsored"]}.items()}
        out, y = [], []

        def add(path, texts, label, linked=0.0, out=out, y=y):
            for t in texts:
                out.append((tuple(path), t, int(len(t) * linked)))
                y.append(label)

        def some(pool, n, g=g):
            return [str(pool[int(g.integers(len(pool)))]) for _ in range(n)]

        if g.random() < 0.4:
            add(("html", "body", str(g.choice(["div cookie-notice", "div consent", "div notice"]))), some(short, 1), 0)
        if g.random() < 0.4:
            add(("html", "body", str(g.choice(["header", "div header", "div masthead"]))), some(short, 1), 0)
        for (path, text, linked), label in zip(rows, labels):
            kind = next((k for k in ("nav", "footer") if any(p.split()[0] == k for p in path)), "ad")
            tail = path[-1] if path else "p"
            if label:
                add(("html", "body", *home, tail if tail.split()[0] in ("p", "h1", "h2", "h3", "li", "blockquote", "pre", "td") else "p"), [text], 1, linked / len(text))
            else:
                add(("html", "body", apart[kind], tail if tail.split()[0] in ("li", "p") else "div"), [text], 0, linked / len(text))
        if g.random() < 0.6:
            box = str(g.choice(["div comments", "section comments", "div comment-list", "ol replies", "div id-comments"]))
            inner = str(g.choice(["div comment", "li comment", "article comment", "div reply"]))
            add(("html", "body", *([home[0]] if g.random() < 0.3 else []), box, inner, "p"), some(prose, int(g.integers(1, 5))), 0)
        if g.random() < 0.5:
            add(("html", "body", str(g.choice(["aside", "div sidebar", "div related", "aside sidebar", "div widget"])), str(g.choice(["li", "p", "div"]))), some(short + prose, int(g.integers(1, 5))), 0, float(g.random()))
        if g.random() < 0.3:
            add(("html", "body", str(g.choice(["form", "form newsletter", "div subscribe", "div share"])), "label"), some(short, int(g.integers(1, 3))), 0)
        yield out, y


class BlockLabeller:
    """Two LSTMs over the sequence of blocks, one each way, and a logistic output on both states."""

    def __init__(self, seed: int = 0):
        g, n = np.random.default_rng(seed), HIDDEN
        self.p = {}
        for way in "fb":
            self.p[f"W{way}"] = g.normal(0, 1 / np.sqrt(24), (WIDTH, 4 * n)).astype(np.float32)
            self.p[f"R{way}"] = g.normal(0, 1 / np.sqrt(n), (n, 4 * n)).astype(np.float32)
            bias = np.zeros(4 * n, np.float32)
            bias[n : 2 * n] = 1  # remember at first
            self.p[f"b{way}"] = bias
        self.p["o"] = g.normal(0, 1 / np.sqrt(2 * n), 2 * n).astype(np.float32)
        self.p["c"] = np.zeros(1, np.float32)

    def run(self, way: str, x: np.ndarray, mask: np.ndarray, state=None) -> dict:
        """x: steps x pages x WIDTH, mask: steps x pages. Steps outside a page leave its state as it is."""
        steps, pages = mask.shape
        n, p = HIDDEN, self.p
        z = x @ p[f"W{way}"] + p[f"b{way}"]
        h, c = state or (np.zeros((pages, n), np.float32), np.zeros((pages, n), np.float32))
        keep = {k: np.empty((steps, pages, n), np.float32) for k in ("i", "f", "o", "g", "h0", "c0", "h", "t")}
        for s in range(steps) if way == "f" else range(steps - 1, -1, -1):
            a = z[s] + h @ p[f"R{way}"]
            i, f, o = (1 / (1 + np.exp(-np.clip(a[:, k * n : (k + 1) * n], -30, 30))) for k in range(3))
            u = np.tanh(a[:, 3 * n :])
            on = mask[s][:, None]
            new = f * c + i * u
            t = np.tanh(new)
            for k, v in (("i", i), ("f", f), ("o", o), ("g", u), ("h0", h), ("c0", c), ("t", t)):
                keep[k][s] = v
            c, h = np.where(on, new, c), np.where(on, o * t, h)
            keep["h"][s] = h
        return keep | {"state": (h, c)}

    def back(self, way: str, x: np.ndarray, mask: np.ndarray, keep: dict, dh_out: np.ndarray) -> dict[str, np.ndarray]:
        steps, pages = mask.shape
        n, p = HIDDEN, self.p
        da = np.zeros((steps, pages, 4 * n), np.float32)
        dh, dc = np.zeros((pages, n), np.float32), np.zeros((pages, n), np.float32)
        for s in range(steps - 1, -1, -1) if way == "f" else range(steps):
            on = mask[s][:, None]
            dh = dh + dh_out[s]
            i, f, o, u, t = (keep[k][s] for k in ("i", "f", "o", "g", "t"))
            dn = dc + dh * o * (1 - t * t)
            a = np.concatenate([dn * u * i * (1 - i), dn * keep["c0"][s] * f * (1 - f), dh * t * o * (1 - o), dn * i * (1 - u * u)], axis=1) * on
            da[s] = a
            dc = np.where(on, dn * f, dc)
            dh = np.where(on, a @ p[f"R{way}"].T, dh)
        flat = da.reshape(-1, 4 * n)
        return {f"W{way}": x.reshape(-1, WIDTH).T @ flat, f"R{way}": keep["h0"].reshape(-1, n).T @ flat, f"b{way}": flat.sum(0)}

    def output(self, forward: dict, backward: dict) -> np.ndarray:
        z = forward["h"] @ self.p["o"][:HIDDEN] + backward["h"] @ self.p["o"][HIDDEN:] + self.p["c"]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    @staticmethod
    def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        steps = max(len(p) for p in pages)
        x, mask = np.zeros((steps, len(pages), WIDTH), np.float32), np.zeros((steps, len(pages)), bool)
        for k, p in enumerate(pages):
            x[: len(p), k], mask[: len(p), k] = p, True
        return x, mask

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 0) -> BlockLabeller:
        """pages: (vectors, labels)."""
        g, step = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for _ in range(epochs):
            order = g.permutation(len(pages))
            for k in range(0, len(order), BATCH):
                pick = [pages[i] for i in order[k : k + BATCH]]
                x, mask = self.padded([p for p, _ in pick])
                # hide some inputs, so that no single tag decides
                x = x * (g.random(x.shape) > 0.15)
                truth = np.zeros(mask.shape, np.float32)
                for i, (_, y) in enumerate(pick):
                    truth[: len(y), i] = y
                f, b = self.run("f", x, mask), self.run("b", x, mask)
                d = (self.output(f, b) - truth) * mask / mask.sum()
                grads = {"o": np.concatenate([np.einsum("sp,spn->n", d, f["h"]), np.einsum("sp,spn->n", d, b["h"])]), "c": d.sum(keepdims=True).reshape(1)}
                grads |= self.back("f", x, mask, f, d[..., None] * self.p["o"][:HIDDEN])
                grads |= self.back("b", x, mask, b, d[..., None] * self.p["o"][HIDDEN:])
                step += 1
                for name, grad in grads.items():
                    m[name] = 0.9 * m[name] + 0.1 * grad
                    v[name] = 0.99 * v[name] + 0.01 * grad**2
                    self.p[name] = (self.p[name] - RATE * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of main text for every block of every page."""
        out: list[np.ndarray] = [np.empty(0)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            # pages of like length together, at most about 4096 steps of pages
            group = [order[at]]
            while at + len(group) < len(order) and len(pages[order[at + len(group)]]) * (len(group) + 1) <= 4096:
                group.append(order[at + len(group)])
            at += len(group)
            if len(pages[group[-1]]) > STRETCH:
                for k in group:
                    out[k] = self.long(pages[k])
                continue
            x, mask = self.padded([pages[k] for k in group])
            y = self.output(self.run("f", x, mask), self.run("b", x, mask))
            for i, k in enumerate(group):
                out[k] = y[: len(pages[k]), i]
        return out

    def long(self, page: np.ndarray) -> np.ndarray:
        """A page of many blocks, in stretches; the states go on from one to the next."""
        starts, ways = list(range(0, len(page), STRETCH)), {}
        for way, order in (("f", starts), ("b", starts[::-1])):
            state, ways[way] = None, {}
            for s in order:
                x = page[s : s + STRETCH][:, None, :]
                got = self.run(way, x, np.ones((len(x), 1), bool), state)
                state, ways[way][s] = got["state"], {"h": got["h"]}
        return np.concatenate([self.output(ways["f"][s], ways["b"][s])[:, 0] for s in starts])


def told(page: str) -> tuple | None:
    """The blocks of a page whose markup says what they are: paths, texts, characters in links, labels; None if it does not teach."""
    if len(page) > TEACH_BYTES:
        return None
    labels: dict[tuple[str, ...], int | None] = {}
    out = []
    for r in blocks(page):
        if r[0] not in labels:
            labels[r[0]] = weak_label(r[0])
        if labels[r[0]] is not None:
            out.append((r, labels[r[0]]))
    if len(out) > TEACH or len({y for _, y in out}) < 2:
        return None
    return [list(r[0]) for r, _ in out], [r[1] for r, _ in out], [r[2] for r, _ in out], [y for _, y in out]


def fit(pages: DataFrame, html: str = "html", sample: int = PAGES) -> BlockLabeller | None:
    """Learns from the ``sample`` telling pages with the smallest hashes of their content; None if no page has a weak label of both kinds.

    All pages are read for that, whatever their number; copies count once. A page teaches with all its
    labelled blocks and their whole texts; pages of over TEACH_BYTES or TEACH such blocks do not teach. Only hashes
    come to the driver first, a task's smallest, and then the pages of the chosen ones.
    """
    rows = pages.select(F.col(f"`{html}`").alias("html")).filter(F.col("html").isNotNull()).select("html", F.xxhash64("html").alias("h"))

    def smallest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the smallest hashes of the task's telling pages, largest of them first out
        held: set[int] = set()
        heap: list[int] = []
        for part in slices(batches, "html"):
            for page, h in zip(part.column(0), part.column(1).to_pylist()):
                if h in held or (len(heap) >= sample and h > -heap[0]):
                    continue
                if told(page.as_py()):
                    held.add(h)
                    heapq.heappush(heap, -h)
                    if len(heap) > sample:
                        held.remove(-heapq.heappop(heap))
        yield pa.RecordBatch.from_arrays([pa.array(sorted(held), pa.int64())], ["h"])

    chosen = [r["h"] for r in rows.mapInArrow(smallest, "h bigint").distinct().orderBy("h").limit(sample).collect()]
    if not chosen:
        return None

    def work(part: pa.RecordBatch) -> pa.RecordBatch | None:
        found = [(h, *page) for h, page in zip(part.column(1).to_pylist(), map(told, part.column(0).to_pylist())) if page]
        columns = list(zip(*found)) or [[]] * 5
        kinds = (pa.int64(), pa.list_(pa.list_(pa.string())), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], ["h", "path", "words", "linked", "label"])

    teachers = map_slices(rows.filter(F.col("h").isin(chosen)), "html", "h bigint, path array<array<string>>, words array<string>, linked array<int>, label array<int>", work)
    got = teachers.dropDuplicates(["h"]).orderBy("h").collect()  # at most ``sample``
    g, taught = np.random.default_rng(0), []
    for r in got:
        page = [(tuple(p), w, n) for p, w, n in zip(r["path"], r["words"], r["linked"])]
        taught += [(vectors(x), np.array(y, np.float32)) for x, y in variants(page, list(r["label"]), g)]
    return BlockLabeller().fit(taught)


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text (blocks labelled as main text, joined by two line feeds), n_chars.

    NULL and empty pages, and pages without main text, give an empty text. Markup may be broken or
    cut short. Without pages to learn from, no block counts as main text. Repeated rows are read each;
    an empty table gives no rows; other columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(fit(pages, html))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        read = [blocks(p) for p in pc.fill_null(part.column(2), "").to_pylist()]
        marks = model.label([vectors(r) for r in read]) if model else [np.zeros(len(r)) for r in read]
        texts = ["\n\n".join(r[1] for r, y in zip(rows, ys) if y >= 0.5) for rows, ys in zip(read, marks)]
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(f"`{page_id}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{html}`").alias("html"))
    return map_slices(rows, "html", "page_id bigint, url string, text string, n_chars bigint", work, 2_000_000)
