"""Main text of HTML pages by a recurrent block labeller.

A page is a sequence of blocks. Each has a vector of its tag path (tags and the
words of class, id and role, hashed with signs), one of its words (hashed) and
some counts. A bidirectional LSTM, in numpy, reads the whole sequence and says
of every block whether it belongs to the article, so that a block is judged by
what stands around it on the page. The chosen blocks, in page order, are the text.

The weights are trained here, once a query on the driver, on ``PAGES``
generated pages in varied layouts (that is the bound of the sample; rows of the
table have no labels), from a fixed seed: the same weights on every run.
Pages of similar length run through the network side by side; the longest run alone.

Defined results: null and empty html and html without text give the empty text;
repeated rows and null ids are extracted like others; pages of any length are
read whole; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from functools import lru_cache
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.blocks import Block, blocks_of
from kpiloom.llm.common import in_arrow, table

PATH, WORDS, COUNTS = 128, 32, 11
INPUT, HIDDEN = PATH + WORDS + COUNTS, 24
PAGES, EPOCHS, BATCH, RATE = 1200, 8, 32, 0.01
_DIGITS = re.compile(r"\d")
STEPS = 20_000  # blocks, with padding, that run side by side


@lru_cache(100_000)
def hashed(name: str, size: int) -> tuple[int, float]:
    value = zlib.crc32(name.encode("utf-8", "replace"))
    return value % size, 1.0 if value >> 31 else -1.0


@lru_cache(200_000)
def hashed_word(word: str) -> tuple[int, float]:
    return hashed(word.lower().strip(".,:;!?()|\"'"), WORDS)


@lru_cache(50_000)
def path_vector(path: tuple[str, ...]) -> np.ndarray:
    out = np.zeros(PATH, np.float32)
    for name in dict.fromkeys(path):
        at, sign = hashed(name, PATH)
        out[at] += sign
    return out


def vectors(blocks: list[Block]) -> np.ndarray:
    """A row per block: its tag path, all of its words, counts of all of it."""
    out = np.zeros((len(blocks), INPUT), np.float32)
    total, before = sum(len(b.text) for b in blocks), 0
    places, signs, counts = [], [], []
    for i, block in enumerate(blocks):
        text = block.text
        words = text.split(" ")
        scale = len(words) ** -0.5
        for at, sign in map(hashed_word, words):
            places.append(i * WORDS + at)
            signs.append(sign * scale)
        n = len(text)
        counts.append((log1p(len(words)) / 4, log1p(n) / 6, block.linked / n, text.count(",") / len(words), text[-1] in ".!?", text[0].isupper(),
                       len(_DIGITS.findall(text)) / n, i / len(blocks), before / total, n / total, 1.0))
        before += n
    out[:, :PATH] = [path_vector(b.path) for b in blocks]
    out[:, PATH:PATH + WORDS] = np.bincount(places, signs, len(blocks) * WORDS).reshape(len(blocks), WORDS)
    out[:, PATH + WORDS:] = counts
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def started(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    out = {}
    for side in ("f", "b"):
        out["x" + side] = rng.normal(0, 0.1, (INPUT, 4 * HIDDEN)).astype(np.float32)
        out["h" + side] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        out["c" + side] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)
    out["w"] = rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32)
    out["o"] = np.zeros(1, np.float32)
    return out


def one_way(x: np.ndarray, here: np.ndarray, weights: dict, side: str, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states (steps, pages, HIDDEN) of one direction; here: whether a page has a block at a step."""
    steps, pages, _ = x.shape
    fed = x.reshape(-1, x.shape[2]) @ weights["x" + side] + weights["c" + side]
    fed = fed.reshape(steps, pages, -1)
    h = c = np.zeros((pages, HIDDEN), np.float32)
    out, kept = np.zeros((steps, pages, HIDDEN), np.float32), []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        gates = fed[t] + h @ weights["h" + side]
        i, f, o = (sigmoid(gates[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN:])
        on = here[t][:, None]
        new = np.where(on, f * c + i * g, c)
        squashed = np.tanh(new)
        if keep:
            kept.append((t, h, c, i, f, o, g, squashed, on))
        c, h = new, np.where(on, o * squashed, h)
        out[t] = h
    return out, kept


def forward(x: np.ndarray, here: np.ndarray, weights: dict, keep: bool = False) -> tuple[np.ndarray, tuple]:
    """Probabilities (steps, pages)."""
    (a, kept_a), (b, kept_b) = (one_way(x, here, weights, side, keep) for side in "fb")
    both = np.concatenate([a, b], axis=2)
    return sigmoid(both @ weights["w"] + weights["o"]), (both, kept_a, kept_b)


def gradients(x: np.ndarray, here: np.ndarray, y: np.ndarray, weights: dict) -> tuple[float, dict]:
    """Cross-entropy of all blocks and its gradients, back through time in both directions."""
    p, (both, kept_a, kept_b) = forward(x, here, weights, True)
    n = here.sum()
    loss = float(-(np.where(y, np.log(p + 1e-9), np.log(1 - p + 1e-9)) * here).sum() / n)
    d = ((p - y) * here / n).astype(np.float32)
    out = {"w": np.einsum("tp,tph->h", d, both), "o": d.sum(keepdims=True).reshape(1)}
    back = d[:, :, None] * weights["w"]
    for side, kept, part in (("f", kept_a, back[:, :, :HIDDEN]), ("b", kept_b, back[:, :, HIDDEN:])):
        dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
        fed = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        out["h" + side] = np.zeros_like(weights["h" + side])
        for t, h, c, i, f, o, g, squashed, on in reversed(kept):
            dh = dh + part[t]
            inner = np.where(on, dh, 0)
            dcell = np.where(on, dc + inner * o * (1 - squashed**2), 0)
            gates = np.concatenate([dcell * g * i * (1 - i), dcell * c * f * (1 - f), inner * squashed * o * (1 - o), dcell * i * (1 - g**2)], axis=1)
            fed[t] = gates
            out["h" + side] += h.T @ gates
            dh, dc = np.where(on, gates @ weights["h" + side].T, dh), np.where(on, dcell * f, dc)
        flat = fed.reshape(-1, 4 * HIDDEN)
        out["x" + side], out["c" + side] = x.reshape(-1, x.shape[2]).T @ flat, flat.sum(axis=0)
    return loss, out


def stacked(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, here = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32), np.zeros((steps, len(pages)), bool)
    for k, page in enumerate(pages):
        x[:len(page), k], here[:len(page), k] = page, True
    return x, here


@lru_cache(1)
def trained(seed: int = 5) -> dict[str, np.ndarray]:
    """Weights after EPOCHS passes over the generated pages, by Adam."""
    pages = [generated(random.Random(f"{seed}/{k}")) for k in range(PAGES)]
    data = sorted(((vectors([b for b, _ in p]), np.array([y for _, y in p])) for p in pages if p), key=lambda d: len(d[0]))
    batches = [data[k:k + BATCH] for k in range(0, len(data), BATCH)]
    weights, rng = started(seed), np.random.default_rng(seed)
    mean, square = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        for k in rng.permutation(len(batches)):
            x, here = stacked([d[0] for d in batches[k]])
            y, _ = stacked([d[1][:, None] for d in batches[k]])
            step += 1
            _, slopes = gradients(x, here, y[:, :, 0] > 0, weights)
            rate = RATE * (1 - epoch / EPOCHS)
            for name, slope in slopes.items():
                mean[name] = 0.9 * mean[name] + 0.1 * slope
                square[name] = 0.99 * square[name] + 0.01 * slope**2
                weights[name] = (weights[name] - rate * mean[name] / (1 - 0.9**step) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return weights


# --- Fixed values: names and phrases of generated pages ---
MAIN = ["content", "post", "entry", "article", "story", "body", "text", "main"]
FURNITURE = {
    "menu": ["nav", "navbar", "menu", "navigation", "breadcrumb", "toc", "pagination", "pager", "tags", "categories"],
    "header": ["header", "masthead", "top", "banner", "branding", "logo", "topbar"],
    "footer": ["footer", "bottom", "copyright", "legal", "colophon"],
    "sidebar": ["sidebar", "aside", "widget", "related", "recommended", "popular", "recent", "trending"],
    "notice": ["cookie", "consent", "notice", "alert", "gdpr", "privacy", "popup", "modal", "overlay", "paywall", "warning"],
    "advert": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner"],
    "form": ["form", "newsletter", "subscribe", "signup", "login", "search", "contact"],
    "share": ["share", "social", "byline", "meta", "author", "date"],
    "comments": ["comments", "comment", "reply", "replies", "discussion", "respond", "disqus", "thread", "reviews"],
}
PHRASES = {
    "menu": ["Home", "About", "Contact", "News", "Next page", "Previous", "Archive", "Login"],
    "header": ["Welcome to our site", "Your daily source", "Sign in", "Skip to content"],
    "footer": ["© 2024 All rights reserved.", "Terms of use · Privacy policy", "Powered by", "Contact us", "Imprint"],
    "sidebar": ["Related articles", "Most read", "You may also like", "Recent posts", "Read more"],
    "notice": ["We use cookies to improve your experience.", "Accept all cookies", "By continuing you agree to our privacy policy.", "Please enable JavaScript"],
    "advert": ["Advertisement", "Sponsored", "Buy now and save 50%", "Shop the sale", "Click here"],
    "form": ["Subscribe to our newsletter", "Your email address", "Search", "Name", "Send", "Leave your details"],
    "share": ["Share on Facebook", "Tweet", "Posted by admin", "5 min read"],
    "comments": ["Comments", "Leave a reply", "Reply", "3 comments", "Report", "Log in to comment", "says:"],
}
TAGS = {"menu": ["nav", "div", "ul", "ol"], "header": ["header", "div"], "footer": ["footer", "div"], "sidebar": ["aside", "div", "section"], "notice": ["div", "section", "aside", "dialog"],
        "advert": ["div", "aside", "section"], "form": ["form", "div"], "share": ["div", "ul"], "comments": ["section", "div", "ol", "ul", "aside"]}
# --- end of fixed values ---


def prose(rng: random.Random, sentences: int, bars: bool = False) -> str:
    syllables = rng.choice([["the", "an", "re", "ing", "ti", "on", "er", "ed"], ["der", "en", "sch", "ge", "ü", "keit"], ["le", "eau", "é", "ment", "ou"], ["la", "ción", "que", "ar", "ez"], ["ka", "no", "mi", "ru", "to"]])
    out = []
    for _ in range(sentences):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(max(1, int(rng.expovariate(1 / 9))))]
        out.append((" | " if bars else " ").join(w + ("," if rng.random() < 0.08 else "") for w in words).capitalize() + (rng.choice(".....!?") if rng.random() < 0.9 else ""))
    return " ".join(out)


def generated(rng: random.Random) -> list[tuple[Block, bool]]:
    """The blocks of a page in a layout of its own, and which belong to its article."""
    mark = "\ue000"  # stands before the text of article blocks

    def named(tag: str, names: list[str], plain: float) -> str:
        if rng.random() < plain:
            return f"<{tag}>"
        name = rng.choice(names)
        name = rng.choice([name, name, f"{rng.choice(['site', 'page', 'main', 'x', 'js', 'block'])}-{name}", f"{name}-{rng.choice(['box', 'wrapper', 'inner', 'area', 'list', 'item'])}"])
        return f'<{tag} {rng.choice(["class", "class", "id"])}="{name}">'

    def furniture(kind: str) -> str:
        tag = rng.choice(TAGS[kind])
        own = tag in ("nav", "header", "footer", "aside", "form")
        head = named(tag, FURNITURE[kind], 0.6 if own else 0.05)
        item = lambda: rng.choice(PHRASES[kind]) if rng.random() < 0.5 else prose(rng, rng.randint(1, 3) if kind in ("advert", "comments", "notice", "footer", "sidebar") else 1)[:rng.choice([15, 40, 400])]
        if kind == "comments":
            inner = "".join(rng.choice([f"<p>{item()}</p>", f"<div class='{rng.choice(['comment', 'reply', 'body'])}'><span>{prose(rng, 1)[:12]}</span> {prose(rng, rng.randint(1, 6))}</div>", f"<li>{prose(rng, rng.randint(1, 4))}</li>"]) for _ in range(rng.randint(1, 6)))
            inner = f"<h3>{item()}</h3>" + inner
        elif kind in ("menu", "sidebar", "share") and rng.random() < 0.8:
            inner = "".join(f"<li><a href='/x'>{item()}</a></li>" for _ in range(rng.randint(2, 9)))
            inner = inner if tag in ("ul", "ol") else f"<ul>{inner}</ul>"
            inner = rng.choice(["", f"<h3>{item()}</h3>"]) + inner
        elif kind == "form":
            inner = "".join(f"<label>{item()}</label><input><p>{item()}</p>" for _ in range(rng.randint(1, 3)))
        else:
            inner = rng.choice([item(), f"<p>{item()}</p>" * rng.randint(1, 2), f"<p>{item()} <a href='/'>{item()}</a></p>", f"<div>{item()}</div>"])
        return f"{head}{inner}</{tag}>"

    bars = rng.random() < 0.1

    def paragraph() -> str:
        body = prose(rng, max(1, int(rng.expovariate(1 / 4))), bars)
        kind = rng.random()
        if kind < 0.72:
            return rng.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<p><em>{}</em></p>"]).format(mark + body)
        if kind < 0.8:
            return f"<h{rng.randint(2, 4)}>{mark}{prose(rng, 1, bars)[:60]}</h2>"
        if kind < 0.86:
            return "<ul>" + "".join(f"<li>{mark}{prose(rng, 1)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if kind < 0.91:
            return f"<blockquote>{mark}{body}</blockquote>"
        if kind < 0.95:
            return f"<div>{mark}{body}</div>"
        if kind < 0.98:
            return "<table><tr>" + "".join(f"<td>{mark}{prose(rng, 1)[:20]}</td>" for _ in range(rng.randint(2, 5))) + "</table>"
        return f"<p>{mark}{body} <a href='/y'>{prose(rng, 1)[:30]}</a> {prose(rng, 1)}</p>"

    title = f"<h1>{mark}{prose(rng, 1, bars)[:80]}</h1>" if rng.random() < 0.85 else ""
    article = title
    for _ in range(max(1, int(rng.expovariate(1 / 8)))):
        article += paragraph()
        if rng.random() < 0.06:
            article += furniture(rng.choice(["advert", "advert", "sidebar", "share", "notice", "form"]))
    holder = rng.choice(["article", "article", "main", "div", "div", "section", "body"])
    if holder != "body":
        article = named(holder, MAIN, 0.5 if holder in ("article", "main") else 0.1) + article + f"</{holder}>"
    some = lambda kinds, rate: "".join(furniture(k) for k in kinds if rng.random() < rate)
    before, after = some(["notice", "header", "menu", "menu", "advert", "form", "share"], 0.4), some(["share", "sidebar", "advert", "form", "comments", "sidebar", "notice", "footer"], 0.4)
    page = f"<body>{before}{article}{after}</body>"
    if rng.random() < 0.3:
        page = page.replace("<body>", "<body><div class='wrapper'><div id='page'>", 1)
    if rng.random() < 0.1:
        page = page[:rng.randint(len(page) // 2, len(page))]
    out = blocks_of(page)
    return [(Block(b.text.replace(mark, "").strip() or "x", b.path, b.linked), mark in b.text) for b in out]


def labels(pages: list[list[Block]], weights: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Of every page, which blocks are main text."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    while order:
        # From the longest down, so many that padding stays small.
        longest = len(pages[order[-1]])
        group = [order.pop()]
        while order and (len(group) + 1) * longest <= STEPS and 2 * len(pages[order[-1]]) >= longest:
            group.append(order.pop())
        x, here = stacked([vectors(pages[k]) for k in group])
        p, _ = forward(x, here, weights)
        for column, k in enumerate(group):
            out[k] = p[:len(pages[k]), column] >= 0.5
    return out


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row for each row of ``pages`` (page_id, url, html)."""
    weights = trained()

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts: list[str] = []
        for begin in range(0, batch.num_rows, 512):
            pages = [blocks_of(page or "") for page in batch.column("html").slice(begin, 512).to_pylist()]
            texts += ["\n".join(b.text for b, y in zip(page, chosen.tolist(), strict=True) if y) for page, chosen in zip(pages, labels(pages, weights), strict=True)]
        return pa.record_batch({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(list(map(len, texts)), pa.int64())})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return in_arrow(rows, each, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
