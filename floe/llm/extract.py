"""Main text of HTML pages by a recurrent block labeller.

A page becomes a sequence of text blocks. Each block is a vector: hashed elements of
its tag path, hashed words, and its length, link share and punctuation. A bidirectional
LSTM in NumPy reads the whole sequence and labels every block, so a block is judged in
the context of its page. It is trained on a bounded sample of pages: as they are, with
labels from their semantic elements, and re-dressed in random layouts whose labels are
known (menus, notices, adverts, side bars, forms, comments and footers around the text).

Defined cases: a null or empty page gives an empty text; without any labelled block to
train on, the layouts alone are learned. Repeated rows are extracted alike.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.blocks import Block, blocks

PATH_DIM, WORD_DIM, PLAIN_DIM = 96, 24, 10
DIM = PATH_DIM + WORD_DIM + PLAIN_DIM
HIDDEN = 20
KEEP = ("article", "main")
LEAVE = ("nav", "header", "footer", "aside", "form", "dialog", "menu", ".comments", ".ad", ".sidebar")


@lru_cache(maxsize=200_000)
def _slot(word: str, size: int) -> tuple[int, float]:
    h = xxhash.xxh64_intdigest(word)
    return h % size, 1.0 if h >> 40 & 1 else -1.0


def vectors(page: list[Block]) -> np.ndarray:
    """One row per block."""
    x = np.zeros((len(page), DIM), np.float32)
    for i, b in enumerate(page):
        row = x[i]
        for depth, part in enumerate(reversed(b.path)):
            k, sign = _slot(part, PATH_DIM)
            row[k] += sign * (1.0 if depth < 6 or part in KEEP or part in LEAVE else 0.5)
        words = b.text.split()
        share = 0.5 * len(words) ** -0.5  # all words count alike, however many there are
        for w in words:
            k, sign = _slot(w.lower(), WORD_DIM)
            row[PATH_DIM + k] += share * sign
        n = len(b.text)
        plain = row[PATH_DIM + WORD_DIM :]
        plain[0] = np.log1p(n) / 4
        plain[1] = b.link_chars / n
        plain[2] = min(1.0, 20 * sum(map(b.text.count, ".,;:!?")) / n)
        plain[3] = len(words) < 4
        plain[4] = i / len(page)
        plain[5] = b.text[-1] in ".!?"
        plain[6] = i == 0
        plain[7] = 1.0
        plain[8] = any(p in LEAVE for p in b.path)
        plain[9] = any(p in KEEP for p in b.path)
    return np.clip(x, -3, 3)


class Labeller:
    """A bidirectional LSTM with a logistic output per block."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.w = {}
        for side in "fb":
            self.w[side + "x"] = rng.normal(0, DIM**-0.5, (DIM, 4 * HIDDEN)).astype(np.float32)
            self.w[side + "h"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
            self.w[side + "b"] = bias
        self.w["o"] = rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32)
        self.w["c"] = np.zeros(1, np.float32)

    def _run(self, side: str, x: np.ndarray, there: np.ndarray, keep: bool):
        """One direction over (pages, time, DIM); padding holds the state."""
        n, t, _ = x.shape
        gates_x = x.reshape(n * t, DIM) @ self.w[side + "x"] + self.w[side + "b"]
        gates_x = gates_x.reshape(n, t, 4 * HIDDEN)
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        hs, tape = np.zeros((n, t, HIDDEN), np.float32), []
        for k in range(t) if side == "f" else range(t - 1, -1, -1):
            g = gates_x[:, k] + h @ self.w[side + "h"]
            s = 1 / (1 + np.exp(-g[:, : 3 * HIDDEN]))
            i, f, o, a = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(g[:, 3 * HIDDEN :])
            m = there[:, k, None]
            new_c = np.where(m, f * c + i * a, c)
            squashed = np.tanh(new_c)
            new_h = np.where(m, o * squashed, h)
            if keep:
                tape.append((k, h, c, i, f, o, a, squashed, m))
            h, c = new_h, new_c
            hs[:, k] = h
        return hs, tape

    def logits(self, x: np.ndarray, there: np.ndarray, keep: bool = False):
        f, tape_f = self._run("f", x, there, keep)
        b, tape_b = self._run("b", x, there, keep)
        both = np.concatenate((f, b), 2)
        return both @ self.w["o"] + self.w["c"][0], both, (tape_f, tape_b)

    def gradients(self, x: np.ndarray, there: np.ndarray, y: np.ndarray, weight: np.ndarray):
        z, both, tapes = self.logits(x, there, True)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        dz = ((p - y) * weight / max(1.0, weight.sum())).astype(np.float32)
        grads = {"o": np.einsum("ntk,nt->k", both, dz), "c": np.array([dz.sum()], np.float32)}
        out = dz[:, :, None] * self.w["o"]
        for side, tape, d_out in (("f", tapes[0], out[:, :, :HIDDEN]), ("b", tapes[1], out[:, :, HIDDEN:])):
            dh, dc = np.zeros_like(d_out[:, 0]), np.zeros_like(d_out[:, 0])
            d_gates = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            gh = np.zeros_like(self.w[side + "h"])
            for k, h, c, i, f, o, a, squashed, m in reversed(tape):
                dh = dh + d_out[:, k]
                d_o = dh * squashed * o * (1 - o)
                d_c = dc + dh * o * (1 - squashed**2)
                g = np.concatenate((d_c * a * i * (1 - i), d_c * c * f * (1 - f), d_o, d_c * i * (1 - a**2)), 1) * m
                d_gates[:, k] = g
                gh += h.T @ g
                dh = np.where(m, g @ self.w[side + "h"].T, dh)
                dc = np.where(m, d_c * f, dc)
            flat = d_gates.reshape(-1, 4 * HIDDEN)
            grads |= {side + "x": x.reshape(-1, DIM).T @ flat, side + "b": flat.sum(0), side + "h": gh}
        return grads

    def labels(self, pages: list[np.ndarray], limit: int = 60_000) -> list[np.ndarray]:
        """Which blocks of each page are main text. Pages of like length share a padded batch."""
        out = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        start = 0
        while start < len(order):
            stop = start + 1
            while stop < len(order) and stop - start < 256 and (stop + 1 - start) * len(pages[order[stop]]) <= limit:
                stop += 1
            group = [pages[i] for i in order[start:stop]]
            x, there = padded(group)
            z = self.logits(x, there)[0]
            for k, i in enumerate(order[start:stop]):
                out[i] = z[k, : len(pages[i])] > 0
            start = stop
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t = max(len(p) for p in pages)
    x, there = np.zeros((len(pages), t, DIM), np.float32), np.zeros((len(pages), t), bool)
    for k, p in enumerate(pages):
        x[k, : len(p)], there[k, : len(p)] = p, True
    return x, there


def semantic_labels(page: list[Block]) -> np.ndarray | None:
    """Labels from the elements that say what they are; None for a page that has no such element."""
    main = np.array([any(p in KEEP for p in b.path) for b in page], bool)
    out = np.array([any(p in LEAVE for p in b.path) for b in page], bool)
    return main & ~out if main.any() else None


_ROLES = {
    "nav": (("nav", "ul", "div"), ("menu", "navbar", "nav", "navigation", "breadcrumb", "site-nav", "topbar", "tabs")),
    "header": (("header", "div"), ("header", "site-header", "masthead", "banner", "branding", "top")),
    "notice": (("div", "section", "aside", "p"), ("cookie-notice", "notice", "consent", "cookie-banner", "alert", "gdpr", "popup", "paywall")),
    "ad": (("div", "aside", "section", "p"), ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad")),
    "aside": (("aside", "div", "section"), ("sidebar", "related", "widget", "side", "recommended", "trending", "share", "social", "tags")),
    "form": (("form", "div"), ("newsletter", "subscribe", "signup", "search", "login", "contact-form")),
    "comments": (("div", "section", "ul", "article"), ("comments", "comment", "replies", "discussion", "comment-list", "responses")),
    "footer": (("footer", "div"), ("footer", "site-footer", "copyright", "legal", "bottom", "colophon")),
}
_MAIN = (("article", "main", "div", "section"), ("content", "post", "article", "entry-content", "story", "main", "post-body", "article-body", "text", ""))


def dressed(texts: list[str], rng: random.Random) -> tuple[list[Block], np.ndarray]:
    """A random page around given paragraphs, with the label of each block."""
    pool = " ".join(texts).split() or ["word"]
    phrase = lambda a, b: " ".join(rng.choices(pool, k=rng.randint(a, b)))
    page: list[tuple[Block, bool]] = []
    outer = ["html", "body"] + rng.choice(([], ["div", ".wrapper"], ["div", ".page", "div", ".container"], ["div"]))

    def part(role: str, where: list[str]) -> None:
        tags, names = _ROLES[role]
        tag, name = rng.choice(tags), rng.choice(names)
        own = [tag] + ([f".{w}" for w in name.split("-")] if tag in ("div", "ul", "p", "section", "article") or rng.random() < 0.5 else [])
        for _ in range({"nav": rng.randint(2, 9), "comments": rng.randint(1, 6), "aside": rng.randint(1, 6), "form": rng.randint(1, 3)}.get(role, rng.randint(1, 2))):
            if role == "nav" or role == "aside" and rng.random() < 0.6:
                text, inner, link = phrase(1, 5), ["ul", "li"] if rng.random() < 0.8 and tag != "ul" else ["li"], 1.0
            elif role == "comments":
                text, inner, link = phrase(3, 45), rng.choice((["p"], ["div", ".comment", "p"], ["li"], [])), 0.0
            else:
                text, inner, link = phrase(2, 25), rng.choice((["p"], [], ["span"], ["div"], ["h3"])), float(rng.random() < 0.3)
            page.append((Block(text, tuple(where + own + inner), int(len(text) * link)), False))

    for role, chance in (("notice", 0.4), ("header", 0.5), ("nav", 0.85), ("ad", 0.4), ("form", 0.15), ("aside", 0.2)):
        if rng.random() < chance:
            part(role, outer)
    tag, name = rng.choice(_MAIN[0]), rng.choice(_MAIN[1])
    own = [tag] + ([f".{w}" for w in name.split("-")] if name and (tag in ("div", "section") or rng.random() < 0.4) else [])
    if tag in ("div", "section") and len(own) == 1 and rng.random() < 0.7:
        own = ["main", *own]
    for k, text in enumerate(texts):
        if k and rng.random() < 0.1:
            part(rng.choice(("ad", "aside", "notice", "form", "nav", "comments")), outer + own)
        if k == 0 and rng.random() < 0.7:
            page.append((Block(phrase(2, 12), tuple(outer + own + ["h1"]), 0), True))
        inner = rng.choices((["p"], ["ul", "li"], ["blockquote", "p"], ["h2"], ["div"], ["table", "tr", "td"], ["pre"]), (12, 2, 1, 2, 2, 1, 0.5))[0]
        page.append((Block(text, tuple(outer + own + inner), int(len(text) * 0.2) if rng.random() < 0.15 else 0), True))
    for role, chance in (("comments", 0.45), ("aside", 0.4), ("ad", 0.25), ("form", 0.35), ("nav", 0.2), ("footer", 0.85)):
        if rng.random() < chance:
            part(role, outer + own if role == "comments" and rng.random() < 0.3 else outer)
    return [b for b, _ in page], np.array([y for _, y in page], bool)


def fit(pages: DataFrame, sample: int = 300, steps: int = 800, batch: int = 24, stretch: int = 120) -> Labeller:
    """Train on at most about ``sample`` pages, chosen by hash, every block of them; long ones in stretches of ``stretch`` blocks."""
    total = pages.filter("html is not null").count()
    rows = pages.filter(F.col("html").isNotNull() & (F.pmod(F.xxhash64("page_id", "html"), F.lit(1_000_000)) < 1_000_000 * sample / max(1, total)))
    sets: list[tuple[np.ndarray, np.ndarray]] = []
    stories: list[list[str]] = []
    for html in sorted(r["html"] for r in rows.select("html").limit(3 * sample).collect()):
        page = blocks(html)
        y = semantic_labels(page)
        if y is None:
            continue
        x = vectors(page)
        sets += [(x[k : k + stretch], y[k : k + stretch]) for k in range(0, len(page), stretch)]
        stories.append([b.text for b, keep in zip(page, y) if keep])
    if not stories:
        stories = [["This is a sentence of some length, written to stand for text.", "Another one follows it, and then the page ends."]]
    rng = random.Random(5)
    for k in range(600):
        story = stories[k % len(stories)]
        begin = rng.randrange(len(story)) if story else 0
        page, y = dressed(story[begin : begin + rng.randint(1, 14)], rng)
        sets.append((vectors(page), y))
    net = Labeller()
    first, second = ({k: np.zeros_like(v) for k, v in net.w.items()} for _ in range(2))
    real = max(1, len(sets) - 600)
    for step in range(1, steps + 1):
        pick = [rng.randrange(real) if rng.random() < 0.4 else rng.randrange(len(sets)) for _ in range(batch)]
        pick.sort(key=lambda i: len(sets[i][1]))
        x, there = padded([sets[i][0] for i in pick])
        y = np.zeros(there.shape, np.float32)
        for k, i in enumerate(pick):
            y[k, : len(sets[i][1])] = sets[i][1]
        grads = net.gradients(x, there, y, there.astype(np.float32))
        norm = sum(float((g**2).sum()) for g in grads.values()) ** 0.5
        rate = 0.01 * min(1.0, 1.5 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g = g * min(1.0, 2.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            net.w[k] = (net.w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def extract(pages: DataFrame, net: Labeller) -> DataFrame:
    """page_id, url, text (main blocks joined by a line feed) and n_chars (its code points)."""
    shared = pages.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                parsed = [blocks(h) for h in batch.column("html").to_pylist()]
                kept = model.labels([vectors(p) for p in parsed])
                texts = ["\n".join(b.text for b, keep in zip(p, k) if keep) for p, k in zip(parsed, kept)]
                yield pa.record_batch({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
