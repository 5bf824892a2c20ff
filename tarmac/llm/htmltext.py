"""Main text of web pages: a bidirectional LSTM labels every block with the page as context.

A page is read into its leaf blocks: runs of text between block-level tags, each with the path of
tags, classes and ids above it. Character references are decoded and white space becomes one
blank. A block's vector counts its hashed path entries and hashed words and adds some figures of
its form; all words count. A numpy LSTM reads the blocks forwards and another backwards; their states give each
block's probability of being main text, and the main blocks are joined in page order.

There are no labels for pages. The network learns from at most ``sample_pages`` pages, those with
the smallest hash of their url, under a teacher that knows which path entries (fixed values
below) hold the article and which never do. So that it meets more than these pages have, copies
of them get another container or more side blocks. The sample and the network have a fixed size;
every page is labelled from its whole html, in one pass without a shuffle.

Scripts, styles, comments and other raw elements hold no text; formulas are inline text. Null and empty html gives empty
text. A page without any main block gives empty text. Repeated rows and null ids are kept.
Unclosed and stray tags are closed as browsers do, in effect. Only the named columns are read.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.shared import text_column

#: The bound of the training sample, in pages.
SAMPLE_PAGES = 250
#: Blocks whose vectors are held at once when pages are labelled.
STEP_BLOCKS = 8_192
PATH_SIZE, WORD_SIZE, FORM_SIZE, HIDDEN = 192, 48, 8, 12
INPUT = PATH_SIZE + WORD_SIZE + FORM_SIZE

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template iframe svg canvas object select textarea title"
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
    "menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag of the key closes an open element of these, up to the elements that hold them.
CLOSES = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "option": ("option", "select"),
}
#: Path entries that the teacher takes for the article, and for what never belongs to it.
ARTICLE = "article main post content story entry body-text articlebody post-content entry-content"
SIDE = (
    "nav menu header footer aside sidebar ad ads advert advertisement sponsored promo banner "
    "cookie cookies consent notice newsletter subscribe signup form button comment comments "
    "respond replies related share sharing social breadcrumb breadcrumbs pagination widget popup "
    "modal login search toolbar masthead copyright"
)
_ARTICLE, _SIDE = frozenset(ARTICLE.split()), frozenset(SIDE.split())

_TOKEN = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)"
    r"|<svg(?=[\s/>])(?>[^>]*)(?<=/)>"
    rf"|<(?P<raw>{'|'.join(RAW.split())})(?=[\s/>])(?>[^>]*)>(?s:.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?](?>[^>]*)(?:>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?>(?:[^>"']|"[^"]*"|'[^']*')*))>""",
    re.IGNORECASE,
)
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PARTS = re.compile(r"[a-z]+(?:-[a-z]+)*")


def blocks(page: str) -> list[tuple[tuple[str, ...], str]]:
    """(path entries, text) of each leaf block with text, in page order."""
    found: list[tuple[tuple[str, ...], str]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []

    def close() -> None:
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if joined:
                found.append((tuple(e for _, es in stack for e in es), joined))

    at = 0
    for token in _TOKEN.finditer(page):
        # An annotation repeats its formula as source.
        if token.start() > at and not (stack and stack[-1][0] == "annotation"):
            text.append(page[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            text.append(" ")
        if token["end"]:
            if name in BLOCKS:
                close()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
                if name not in BLOCKS and stack[i][0] in BLOCKS:
                    break
            continue
        if name in BLOCKS:
            close()
            _close_implied(stack, name)
        # Text within an unclosed head is the body's: what a head may hold is raw or void.
        if name not in VOID and name != "head" and not token["rest"].endswith("/"):
            entry = [name]
            if token["rest"]:
                for marks in _MARKS.findall(token["rest"].lower()):
                    entry.extend(_PARTS.findall("".join(marks)))
            stack.append((name, tuple(entry)))
    text.append(page[at:])
    close()
    return found


def _close_implied(stack: list[tuple[str, tuple[str, ...]]], name: str) -> None:
    """Any block closes an open paragraph; list items, cells and rows close their like."""
    closed, holders = CLOSES.get(name, ("", ""))
    closed, holders = [*closed.split(), "p"], holders.split()
    first = None
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in closed:
            first = i
        elif stack[i][0] in holders or (not holders and stack[i][0] in BLOCKS):
            break
    if first is not None:
        del stack[first:]


def taught(path: tuple[str, ...]) -> bool:
    """The teacher's label: below an article and below nothing that is beside it."""
    return any(e in _ARTICLE for e in path) and not any(e in _SIDE for e in path)


_slots: dict[str, int] = {}


def _slot(entry: str, size: int, offset: int) -> int:
    if len(_slots) > 200_000:
        _slots.clear()
    key = f"{offset}{entry}"
    slot = _slots.get(key)
    if slot is None:
        slot = _slots[key] = offset + zlib.crc32(entry.encode("utf-8", "replace")) % size
    return slot


def vectors(
    sequence: list[tuple[tuple[str, ...], str]], first: int = 0, size: int | None = None
) -> np.ndarray:
    """A row of features per block; ``sequence`` may be a part of a page of ``size`` blocks."""
    rows, columns, values = [], [], []
    form = np.zeros((len(sequence), FORM_SIZE))
    size = size or len(sequence)
    for i, (path, text) in enumerate(sequence):
        words = text.split(" ")
        for k, entry in enumerate(path):
            rows.append(i)
            columns.append(_slot(entry, PATH_SIZE, 0))
            values.append(1.0)
            if k == len(path) - 1:
                rows.append(i)
                columns.append(_slot("leaf " + entry, PATH_SIZE, 0))
                values.append(1.0)
        share = 1.0 / len(words)
        rows.extend([i] * len(words))
        columns.extend([_slot(word, WORD_SIZE, PATH_SIZE) for word in words])
        values.extend([share] * len(words))
        n = len(text)
        form[i] = (
            np.log1p(n) / 5, np.log1p(len(words)) / 4, n / len(words) / 10,
            sum(text.count(c) for c in ".!?") / len(words), ("©" in text) * 1.0,
            ("|" in text) * 1.0, (first + i) / size, 1.0,
        )
    places = np.array(rows, dtype=np.int64) * INPUT + np.array(columns, dtype=np.int64)
    x = np.bincount(places, weights=values, minlength=len(sequence) * INPUT).reshape(-1, INPUT)
    x[:, PATH_SIZE + WORD_SIZE :] = form
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


class Layout:
    """Sequences side by side, the longest first: which rows take step t, in either direction."""

    def __init__(self, lengths: np.ndarray):
        first = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        order = np.argsort(-lengths, kind="stable")
        self.begin, self.length = first[order], lengths[order]
        steps = np.arange(1, (self.length[0] if len(lengths) else 0) + 1)
        self.alive = np.searchsorted(-self.length, -steps, side="right")

    def rows(self, t: int, backwards: bool) -> np.ndarray:
        k = self.alive[t]
        return self.begin[:k] + (self.length[:k] - 1 - t if backwards else t)


class Lstm:
    """One direction: input, recurrent and bias weights of the gates i, f, o and the candidate."""

    def __init__(self, weights: np.ndarray, backwards: bool):
        self.wx, self.wh, self.b = np.split(weights, [INPUT, INPUT + HIDDEN])
        self.backwards = backwards

    def forward(self, x: np.ndarray, layout: Layout, keep: bool = False, state=None):
        """The states of all blocks, and the tape if wanted; ``last`` is the state at the end."""
        pre = x @ self.wx + self.b
        states = np.zeros((len(x), HIDDEN))
        h, c = state or (np.zeros((len(layout.begin), HIDDEN)),) * 2
        tape = []
        for t, k in enumerate(layout.alive):
            at = layout.rows(t, self.backwards)
            z = pre[at] + h[:k] @ self.wh
            gates, g = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            h_before, c_before = h[:k], c[:k]
            c = f * c_before + i * g
            tanh = np.tanh(c)
            h = o * tanh
            states[at] = h
            if keep:
                tape.append((at, i, f, o, g, h_before, c_before, tanh))
        self.last = h, c
        return states, tape

    def backward(self, x: np.ndarray, tape: list, grad: np.ndarray) -> np.ndarray:
        dz_all = np.zeros((len(x), 4 * HIDDEN))
        dwh = np.zeros_like(self.wh)
        dh_next = dc_next = np.zeros((0, HIDDEN))
        for at, i, f, o, g, h_before, c_before, tanh in reversed(tape):
            dh, dc = grad[at].copy(), np.zeros((len(at), HIDDEN))
            dh[: len(dh_next)] += dh_next
            dc[: len(dc_next)] += dc_next
            dc += dh * o * (1 - tanh**2)
            dz = np.concatenate(
                [
                    dc * g * i * (1 - i), dc * c_before * f * (1 - f),
                    dh * tanh * o * (1 - o), dc * i * (1 - g**2),
                ],
                axis=1,
            )
            dz_all[at] = dz
            dwh += h_before.T @ dz
            dh_next, dc_next = dz @ self.wh.T, dc * f
        return np.concatenate([x.T @ dz_all, dwh, dz_all.sum(axis=0, keepdims=True)])


class Labeller:
    """Both directions and the output layer."""

    def __init__(self, weights: list[np.ndarray]):
        self.weights = weights
        self.ahead, self.back = Lstm(weights[0], False), Lstm(weights[1], True)

    def probabilities(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        layout = Layout(lengths)
        states = [d.forward(x, layout)[0] for d in (self.ahead, self.back)]
        return self._outcome(np.concatenate(states, axis=1))

    def long_probabilities(self, sequence: list[tuple[tuple[str, ...], str]]) -> np.ndarray:
        """The same for one page of very many blocks, whose vectors are made part by part."""
        n = len(sequence)
        states = np.zeros((n, 2 * HIDDEN))
        parts = range(0, n, STEP_BLOCKS)
        for lstm, column, order in ((self.ahead, 0, parts), (self.back, HIDDEN, reversed(parts))):
            state = None
            for at in order:
                part = sequence[at : at + STEP_BLOCKS]
                x = vectors(part, at, n)
                found, _ = lstm.forward(x, Layout(np.array([len(part)])), state=state)
                states[at : at + len(part), column : column + HIDDEN] = found
                state = lstm.last
        return self._outcome(states)

    def _outcome(self, states: np.ndarray) -> np.ndarray:
        return _sigmoid(states @ self.weights[2][:-1] + self.weights[2][-1])


def fit(
    pages: list[tuple[np.ndarray, np.ndarray]], rounds: int = 60, batch: int = 128, seed: int = 7
) -> Labeller:
    """Train on (block vectors, labels) of pages with Adam."""
    random = np.random.default_rng(seed)
    weights = [
        random.normal(0, 0.1, (INPUT + HIDDEN + 1, 4 * HIDDEN)),
        random.normal(0, 0.1, (INPUT + HIDDEN + 1, 4 * HIDDEN)),
        random.normal(0, 0.1, 2 * HIDDEN + 1),
    ]
    if not pages:
        weights[2][:] = [0.0] * (2 * HIDDEN) + [-5.0]
        return Labeller(weights)
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(rounds):
        order = random.permutation(len(pages))
        for part in np.split(order, range(batch, len(order), batch)):
            x = np.concatenate([pages[p][0] for p in part])
            y = np.concatenate([pages[p][1] for p in part])
            layout = Layout(np.array([len(pages[p][1]) for p in part]))
            model = Labeller(weights)
            ahead, tape = model.ahead.forward(x, layout, keep=True)
            back, tape2 = model.back.forward(x, layout, keep=True)
            states = np.concatenate([ahead, back], axis=1)
            d = (_sigmoid(states @ weights[2][:-1] + weights[2][-1]) - y) / len(y)
            ds = d[:, None] * weights[2][:-1]
            grads = [
                model.ahead.backward(x, tape, ds[:, :HIDDEN]),
                model.back.backward(x, tape2, ds[:, HIDDEN:]),
                np.append(states.T @ d, d.sum()),
            ]
            step += 1
            for k, g in enumerate(grads):
                g += 1e-6 * weights[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                rate = 0.02 / (1 + step / 300)
                weights[k] = weights[k] - rate * (m[k] / (1 - 0.9**step)) / (
                    np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8
                )
    return Labeller(weights)


#: What altered copies put below side marks, and leaves that main and side blocks may both have.
SIDE_LEAVES = (("div",), ("section",), ("ul",), ("aside",), ("div", "div"), ())
LEAVES = "h1 h2 h3 h4 p li blockquote pre td div span label a figcaption".split()


def examples(pages: list[str], seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vectors and the teacher's labels of the pages and of two altered copies of each."""
    random = np.random.default_rng(seed)
    side, containers = SIDE.split(), ARTICLE.split()
    out = []
    for page in pages:
        sequence = blocks(page)
        labels = [taught(path) for path, _ in sequence]
        if not sequence:
            continue
        out.append((vectors(sequence), np.array(labels, dtype=float)))
        spare = [text for _, text in sequence]
        for _ in range(2):
            container = containers[random.integers(len(containers))]
            tags = ("div", container) if random.random() < 0.5 else (container,)
            altered: list[tuple[tuple[str, ...], str]] = []
            truth: list[bool] = []
            for (path, text), label in zip(sequence, labels):
                if label and "article" in path:
                    k = path.index("article")
                    path = (*path[:k], *tags, *path[k + 1 :])
                if label and path[-1] in ("p", "b") and random.random() < 0.3:
                    path = (*path[:-1], LEAVES[random.integers(len(LEAVES))])
                altered.append((path, text))
                truth.append(label)
                if random.random() < 0.25:
                    mark = side[random.integers(len(side))]
                    above = path[:-1] if random.random() < 0.5 else ("html", "body")
                    leaf = SIDE_LEAVES[random.integers(len(SIDE_LEAVES))]
                    words = spare[random.integers(len(spare))].split(" ")
                    cut = words[: 1 + random.integers(40)]
                    altered.append(((*above, *leaf, mark), " ".join(cut)))
                    if random.random() < 0.5:
                        inner = LEAVES[random.integers(len(LEAVES))]
                        altered[-1] = ((*above, *leaf, mark, inner), " ".join(cut))
                    truth.append(False)
            out.append((vectors(altered), np.array(truth, dtype=float)))
    return out


def train(
    pages: DataFrame, url: str = "url", html: str = "html", sample_pages: int = SAMPLE_PAGES
) -> Labeller:
    chosen = (
        pages.select(F.xxhash64(F.col(url).cast("string"), F.length(html)).alias("h"), F.col(html).alias("html"))
        .where(F.length("html") > 0)
        .orderBy("h", F.length("html"))
        .limit(sample_pages)
    )

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = examples([x.as_py() for x in batch.column(0)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x.astype(np.float32).tobytes() for x, _ in made], pa.binary()),
                    pa.array([y.astype(np.float32).tobytes() for _, y in made], pa.binary()),
                ],
                names=["x", "y"],
            )

    rows = chosen.select("html").mapInArrow(sampled, "x binary, y binary").collect()
    made = [
        (
            np.frombuffer(r.x, np.float32).reshape(-1, INPUT).astype(np.float64),
            np.frombuffer(r.y, np.float32).astype(np.float64),
        )
        for r in sorted(rows, key=lambda r: (r.x, r.y))
    ]
    return fit(made)


def main_texts(pages: list[str], model: Labeller, threshold: float = 0.5) -> list[str]:
    """The main text of each page; pages are labelled together up to ``STEP_BLOCKS`` blocks."""
    out: list[str] = []
    waiting: list[list[tuple[tuple[str, ...], str]]] = []

    def chosen(sequence, p: np.ndarray) -> str:
        main = p >= threshold
        return "\n\n".join(text for (_, text), is_main in zip(sequence, main) if is_main)

    def label() -> None:
        lengths = np.array([len(s) for s in waiting], dtype=np.int64)
        p = np.zeros(0)
        if lengths.sum():
            x = np.concatenate([vectors(s) for s in waiting if s])
            p = model.probabilities(x, lengths[lengths > 0])
        ends = np.cumsum(lengths)
        out.extend(chosen(s, p[end - len(s) : end]) for s, end in zip(waiting, ends))
        waiting.clear()

    for page in pages:
        sequence = blocks(page)
        if waiting and sum(map(len, waiting)) + len(sequence) > STEP_BLOCKS:
            label()
        if len(sequence) > STEP_BLOCKS:
            out.append(chosen(sequence, model.long_probabilities(sequence)))
        else:
            waiting.append(sequence)
    label()
    return out


def extract(pages: DataFrame, model: Labeller, keep: list[str], html: str = "html") -> DataFrame:
    """``keep`` columns with text, the page's main text."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    rows = pages.select(*keep, text_column(pages, html).alias("__html"))
    names = rows.columns[:-1]
    schema = ", ".join(
        [*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), "text string"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = main_texts(part.column(len(names)).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(names)], pa.array(texts, pa.string())],
                    names=[*names, "text"],
                )

    return rows.mapInArrow(run, schema)
