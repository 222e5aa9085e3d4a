"""Main-text extraction: a bidirectional LSTM labels the leaf blocks of a page.

A page is cut into blocks, the runs of text between block-level tags. Every
block has a vector: learned embeddings of its hashed tag path (tags, classes,
ids, roles), learned embeddings of its hashed words, and a few numbers. One
LSTM reads a page's blocks forwards, one backwards, so each label sees the
whole document. The network is numpy alone and is trained where it is used,
on generated pages whose blocks have known labels; fixed seeds make it the
same everywhere.
"""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallaxis.llm.common import slices

#: Hashed places of path parts and words, their embedding width, LSTM width.
PATHS, WORDS, WIDTH, HIDDEN = 1024, 512, 12, 12
#: Generated training pages, passes over them, pages a step.
PAGES, PASSES, STEP = 360, 8, 24
NUMBERS = 5

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr nobr".split())
#: Elements that stand within a line, with those of formulas and drawings: they don't end a block.
INLINE |= frozenset("svg g path circle ellipse line rect polygon polyline defs use symbol text tspan math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover mpadded mphantom semantics annotation object canvas audio video iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose inside is no text of the page; all others are left to the labeller.
RAW = ("script", "style", "template")
#: What a start tag ends when it is open (fixed rules of the HTML syntax).
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li td tr".split())
PARTS = re.compile(r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|([^<]+|<)", re.S | re.I)
NAMES = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def place(text: str, size: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % size


def blocks(page: str | None) -> list[tuple[str, tuple, int]]:
    """``(text, path, linked)`` of each block in page order: white space is one space, references decoded.

    ``path`` holds the names of open elements with classes, ids and roles;
    ``linked`` counts characters inside links.
    """
    out: list = []
    if not page:
        return out
    stack: list[tuple[str, tuple]] = []
    held: list[str] = []
    path: tuple = ()
    linked = links = 0

    def flush():
        nonlocal held, linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append((text, path, linked))
        held, linked = [], 0

    def truncate(depth):
        nonlocal links, path
        links -= sum(x[0] == "a" for x in stack[depth:])
        del stack[depth:]
        path = tuple(name for _, names in stack for name in names)

    for raw, slash, tag, rest, text in PARTS.findall(page):
        if text:
            if not held and path is not None:
                path = tuple(name for _, names in stack for name in names)
            held.append(text)
            if links:
                linked += len(text)
            continue
        if raw or not tag:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if slash:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        links -= tag == "a"
                        del stack[k]
                        break
                    if stack[k][0] not in INLINE:
                        break
            elif not rest.endswith("/"):
                stack.append((tag, (tag,)))
                links += tag == "a"
            continue
        if tag == "br" or tag == "img":
            held.append(" ")
            continue
        flush()
        if slash:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    truncate(k)
                    break
        else:
            if tag in ENDS_P:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        truncate(k)
                        break
                    if stack[k][0] not in INLINE:
                        break
            ends = CLOSES.get(tag)
            if ends:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in ends:
                        truncate(k)
                        break
                    if stack[k][0] not in INLINE and stack[k][0] != "p":
                        break
            if tag not in VOID and not rest.endswith("/"):
                names = [tag]
                if "=" in rest:
                    for kind, *values in NAMES.findall(rest):
                        names += [f"{kind.lower()}:{x}" for v in values for x in re.split(r"[\s_\-]+", v.lower()) if x]
                stack.append((tag, tuple(names)))
                path = tuple(name for _, names in stack for name in names)
    flush()
    return out


def encode(found: list[tuple[str, tuple, int]], known: dict):
    """Hashed path places, hashed places of all words and numbers of a page's blocks; ``known`` keeps places of paths and words."""
    paths, words, numbers = [], [], []
    for text, path, linked in found:
        if path not in known:
            known[path] = np.array([place(p, PATHS) for p in path] or [0])
        paths.append(known[path])
        own = text.lower().split(" ")
        for w in own:
            if w not in known:
                known[w] = place(w, WORDS)
        words.append(np.array([known[w] for w in own], np.int16))
        size = len(text)
        numbers.append((min(np.log1p(size) / 6, 2.0), min(linked / size, 1.0), text[-1] in ".!?…", min(text.count(",") / (len(own) or 1), 1.0), min(len(own) / 50, 2.0)))
    return paths, words, np.array(numbers, float).reshape(-1, NUMBERS)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(rng) -> dict:
    width = 2 * WIDTH + NUMBERS
    model = {"path": rng.normal(0, 0.3, (PATHS, WIDTH)), "word": rng.normal(0, 0.1, (WORDS, WIDTH)), "out": rng.normal(0, 0.3, 2 * HIDDEN + width), "bias": np.zeros(1)}
    for side in "fb":
        model[f"x{side}"] = rng.normal(0, 0.25, (width, 4 * HIDDEN))
        model[f"h{side}"] = rng.normal(0, 0.25, (HIDDEN, 4 * HIDDEN))
        model[f"c{side}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    return model


def _bags(parts: list[np.ndarray]):
    sizes = np.array([len(p) for p in parts])
    return np.concatenate(parts), sizes, np.repeat(np.arange(len(parts)), sizes)


def vectors(model: dict, paths, words, numbers) -> np.ndarray:
    """Input vectors of blocks: mean embeddings and numbers."""
    out = [numbers]
    for name, parts in (("word", words), ("path", paths)):
        flat, sizes, _ = _bags(parts)
        out.insert(0, np.add.reduceat(model[name][flat], np.cumsum(sizes) - sizes) / sizes[:, None])
    return np.concatenate(out, 1)


def _lstm(model, side, x, keep=False):
    """States of one direction over (pages, blocks, width); backwards means reversed input."""
    n, steps, _ = x.shape
    gates = x @ model[f"x{side}"] + model[f"c{side}"]
    h = c = np.zeros((n, HIDDEN))
    states, cache = np.empty((n, steps, HIDDEN)), []
    for t in range(steps):
        z = gates[:, t] + h @ model[f"h{side}"]
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        before, h_before = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        states[:, t] = h
        if keep:
            cache.append((i, f, o, g, before, tc, h_before))
    return states, cache


def _flip(x, lengths):
    """Each page's blocks in reverse, padding left behind them."""
    at = np.arange(x.shape[1])
    index = np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)
    return np.take_along_axis(x, index[:, :, None], 1)


def probabilities(model: dict, x: np.ndarray, lengths: np.ndarray):
    """Probability of main text for each block of padded pages."""
    ahead, ahead_cache = _lstm(model, "f", x, True)
    back, back_cache = _lstm(model, "b", _flip(x, lengths), True)
    joint = np.concatenate([ahead, _flip(back, lengths), x], 2)
    return _sigmoid(joint @ model["out"] + model["bias"][0]), joint, ahead_cache, back_cache


def _lstm_back(model, side, x, cache, d_states, grads):
    n, steps, _ = x.shape
    dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    d_gates = np.empty((n, steps, 4 * HIDDEN))
    for t in range(steps - 1, -1, -1):
        i, f, o, g, before, tc, h_before = cache[t]
        dh = dh + d_states[:, t]
        dc = dc + dh * o * (1 - tc * tc)
        z = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        d_gates[:, t] = z
        grads[f"h{side}"] += h_before.T @ z
        dh, dc = z @ model[f"h{side}"].T, dc * f
    grads[f"x{side}"] += np.tensordot(x, d_gates, ([0, 1], [0, 1]))
    grads[f"c{side}"] += d_gates.sum((0, 1))
    return d_gates @ model[f"x{side}"].T


def gradients(model: dict, pages: list, labels: list[np.ndarray]) -> tuple[float, dict]:
    """Mean cross-entropy of a group of pages and its gradients."""
    lengths = np.array([len(y) for y in labels])
    paths, words = sum((p for p, _, _ in pages), []), sum((w for _, w, _ in pages), [])
    flat = vectors(model, paths, words, np.concatenate([n for _, _, n in pages]))
    mask = np.arange(lengths.max()) < lengths[:, None]
    x = np.zeros((*mask.shape, flat.shape[1]))
    x[mask] = flat
    y = np.zeros(mask.shape)
    y[mask] = np.concatenate(labels)
    p, joint, ahead_cache, back_cache = probabilities(model, x, lengths)
    total = mask.sum()
    loss = -(np.log(np.where(y > 0, p, 1 - p).clip(1e-12)) * mask).sum() / total
    error = (p - y) * mask / total
    grads = {k: np.zeros_like(v) for k, v in model.items()}
    grads["out"] = np.tensordot(error, joint, ([0, 1], [0, 1]))
    grads["bias"] = error.sum(keepdims=True).reshape(1)
    d_joint = error[:, :, None] * model["out"]
    dx = d_joint[:, :, 2 * HIDDEN :] + _lstm_back(model, "f", x, ahead_cache, d_joint[:, :, :HIDDEN], grads)
    dx = dx + _flip(_lstm_back(model, "b", _flip(x, lengths), back_cache, _flip(d_joint[:, :, HIDDEN : 2 * HIDDEN], lengths), grads), lengths)
    d_flat = dx[mask]
    for k, (name, parts) in enumerate((("path", paths), ("word", words))):
        places, sizes, owner = _bags(parts)
        np.add.at(grads[name], places, (d_flat[:, k * WIDTH : (k + 1) * WIDTH] / sizes[:, None])[owner])
    return loss, grads


def generated_page(rng) -> tuple[str, list[int]]:
    """A made-up page and the labels of its blocks, in the order of ``blocks``."""
    pick = lambda *x: x[rng.integers(len(x))]
    syllables = ["the", "an", "er", "ion", "sta", "que", "le", "ung", "de", "mi", "ar", "os", "ré", "ble", "tor", "ka", "in", "ü"]
    word = lambda: "".join(pick(*syllables) for _ in range(rng.integers(1, 4)))
    some = lambda a, b: " ".join(word() for _ in range(rng.integers(a, b)))
    sentence = lambda: (some(3, 16).capitalize() + pick(".", ".", ".", "!", "?"))
    prose = lambda: " ".join(sentence() for _ in range(rng.integers(1, 7)))
    chatter = lambda: pick(some(1, 5), some(1, 3), sentence(), prose(), pick("Home", "About us", "Contact", "Read more", "Share", "Subscribe", "Log in", "Search", "Accept cookies", "Privacy policy", "Advertisement", "Sponsored", "Reply"))
    out, labels = [], []

    def put(body, label):
        out.append(body)
        labels.append(label)

    def element(tag, names=""):
        return f"<{tag}" + (f' {pick("class", "class", "id")}="{names}"' if names else "") + ">"

    def link_list(tag, names):
        out.append(element(tag, names) + "<ul>")
        for _ in range(rng.integers(2, 9)):
            put(f'<li><a href="/{word()}">{pick(some(1, 4), chatter())}</a></li>', 0)
        out.append(f"</ul></{tag}>")

    def boxed(tag, names, inner=("p", "div", "span", "")):
        out.append(element(tag, names))
        for _ in range(rng.integers(1, 4)):
            own = pick(*inner)
            put(f"<{own}>{chatter()}</{own}>" if own not in ("", "span") else f"<div>{chatter()}</div>" if own else chatter() + "<hr>", 0)
        out.append(f"</{tag}>")

    def advert():
        names = pick("ad", "ads", "advert", "ad-box", "banner ad", "promo", "sponsored", "advertisement")
        if rng.random() < 0.5:
            put(f"{element('div', names)}{pick(chatter(), prose(), sentence())}</div>", 0)
        else:
            boxed(pick("div", "aside", "section"), names)

    def notice():
        boxed(pick("div", "section", "aside"), pick("notice", "cookie-notice", "cookie", "alert", "banner", "consent", "message warning", "popup"))

    def form():
        out.append(element("form", pick("", "search", "newsletter", "login", "comment-form", "subscribe")))
        for _ in range(rng.integers(1, 4)):
            put(f"<{pick('p', 'div', 'legend', 'button')}>{pick(some(1, 4), chatter())}</p>", 0)
        out.append("</form>")

    def sidebar():
        tag, names = pick(("aside", ""), ("aside", "sidebar"), ("div", "sidebar"), ("aside", "related"), ("div", "widget"), ("section", "related posts"), ("div", "share social"))
        if rng.random() < 0.5:
            link_list(tag, names)
        else:
            boxed(tag, names, ("p", "h3", "div"))

    def comments():
        tag, names, each = pick(("section", "comments", "comment"), ("div", "comments", "comment"), ("ol", "comment-list", "comment"), ("div", "responses", "reply comment"), ("section", "reader-comments", "user-comment"))
        out.append(element(tag, names))
        put(f"<{pick('h2', 'h3')}>{pick('Comments', some(1, 3))}</h3>".replace("h3>", "h3>"), 0) if rng.random() < 0.6 else None
        for _ in range(rng.integers(1, 6)):
            out.append(element("li" if tag == "ol" else pick("div", "article", "div"), each))
            put(f"<p>{prose()}</p>", 0)
            out.append("</li>" if tag == "ol" else "</div></article>")
        out.append(f"</{tag}>")

    def content():
        kind = rng.random()
        if kind < 0.62:
            put(pick("<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<p><i>{}</i></p>").format(prose()), 1)
        elif kind < 0.72:
            put(f"<h2>{some(1, 9)}</h2>", 1)
        elif kind < 0.8:
            tag = pick("ul", "ol")
            out.append(f"<{tag}>")
            for _ in range(rng.integers(2, 6)):
                put(f"<li>{pick(sentence(), some(2, 9), prose())}</li>", 1)
            out.append(f"</{tag}>")
        elif kind < 0.86:
            put(f"<blockquote>{prose()}</blockquote>", 1)
        elif kind < 0.9:
            put(f"<pre>{some(4, 30)}</pre>", 1)
        elif kind < 0.94:
            out.append("<table><tr>")
            for _ in range(rng.integers(2, 6)):
                put(f"<td>{some(1, 6)}</td>", 1)
            out.append("</tr></table>")
        else:
            put(f'<p>{prose()} <a href="/{word()}">{some(1, 4)}</a> {sentence()}</p>', 1)

    title = pick(some(2, 12), sentence())
    out.append("<!DOCTYPE html><html><head>")
    put(f"<title>{title}</title>", 0)
    out.append("<style>p{}</style><script>var t='</p>';</script></head><body>")
    if rng.random() < 0.4:
        out.append(element("header", pick("", "site-header", "masthead")) if rng.random() < 0.7 else element("div", pick("header", "site-header", "topbar")))
        put(f"<{pick('p', 'div')}>{some(1, 5)}</p>", 0)
        out.append("</header></div>")
    if rng.random() < 0.9:
        tag, names = pick(("nav", ""), ("nav", ""), ("nav", "menu"), ("div", "menu"), ("div", "navbar nav"), ("div", "navigation"))
        link_list(tag, names)
    for extra, chance in ((notice, 0.3), (advert, 0.6), (form, 0.2), (sidebar, 0.2)):
        if rng.random() < chance:
            extra()
    tag, names = pick(("article", ""), ("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article-body"), ("div", "post entry"), ("section", "story"), ("div", "main text"))
    out.append(element(tag, names))
    if rng.random() < 0.9:
        put(pick("<h1>{}</h1>", "<h1>{}</h1>", "<header><h1>{}</h1></header>").format(title), 1)
    for _ in range(rng.integers(1, 16)):
        content()
        if rng.random() < 0.06:
            pick(advert, sidebar, form, notice)()
    if rng.random() < 0.1:
        comments()
    out.append(f"</{tag}>")
    for extra, chance in ((comments, 0.35), (advert, 0.2), (form, 0.25), (sidebar, 0.35), (notice, 0.1)):
        if rng.random() < chance:
            extra()
    if rng.random() < 0.9:
        tag, names = pick(("footer", ""), ("footer", ""), ("footer", "site-footer"), ("div", "footer"), ("div", "copyright footer"))
        out.append(element(tag, names))
        for _ in range(rng.integers(1, 3)):
            body = pick(f"&copy; {word()}.example &middot; {sentence()}", f"&copy; 2020 {some(1, 3)}", chatter(), prose())
            put(pick(f"<p>{body}</p>", f"<div>{body}</div>"), 0)
        out.append(f"</{tag}>")
    out.append("</body></html>" if rng.random() < 0.9 else "")
    return "".join(out), labels


def train(pages: int = PAGES, passes: int = PASSES, seed: int = 5) -> dict:
    """A model trained by Adam on generated pages."""
    rng = np.random.default_rng(seed)
    known: dict = {}
    data = []
    while len(data) < pages:
        page, labels = generated_page(rng)
        found = blocks(page)
        if len(found) == len(labels):
            data.append((encode(found, known), np.array(labels, float)))
    model = initial(rng)
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    step = 0
    for epoch in range(passes):
        order = rng.permutation(len(data))
        for start in range(0, len(order), STEP):
            group = [data[k] for k in order[start : start + STEP]]
            _, grads = gradients(model, [g[0] for g in group], [g[1] for g in group])
            step += 1
            rate = 0.02 * (1 - epoch / passes) + 0.001
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                model[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return model


def main_texts(pages: list[str | None], model: dict, known: dict) -> list[str]:
    """The main text of each page: blocks labelled 1, in order, joined by two line feeds."""
    found = [blocks(p) for p in pages]
    sizes = np.array([len(f) for f in found])
    out = [""] * len(pages)
    order = [k for k in np.argsort(sizes, kind="stable") if sizes[k]]
    start = 0
    while start < len(order):
        stop = start + 1  # pages of like length, up to 8192 padded blocks
        while stop < len(order) and sizes[order[stop]] * (stop + 1 - start) <= 8192:
            stop += 1
        group = order[start:stop]
        coded = [encode(found[k], known) for k in group]
        flat = vectors(model, sum((c[0] for c in coded), []), sum((c[1] for c in coded), []), np.concatenate([c[2] for c in coded]))
        lengths = sizes[group]
        mask = np.arange(lengths.max()) < lengths[:, None]
        x = np.zeros((*mask.shape, flat.shape[1]))
        x[mask] = flat
        good = probabilities(model, x, lengths)[0] >= 0.5
        for row, k in enumerate(group):
            out[k] = "\n\n".join(text for (text, _, _), keep in zip(found[k], good[row], strict=False) if keep)
        start = stop
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: dict | None = None) -> DataFrame:
    """One row per page: id, url, text, n_chars (code points).

    A null or empty page, or one without main text, has an empty text.
    Repeated rows, null ids and null urls pass through; other columns are
    ignored. Pages are whole; memory is bounded by batches cut by bytes.
    """
    model = train() if model is None else model
    schema = f"`{id_col}` {pages.schema[id_col].dataType.simpleString()}, `{url_col}` string, text string, n_chars long"

    def run(batches):
        known: dict = {}
        for whole in batches:
            for batch in slices(whole, "_html", 2 << 20):
                if len(known) > 50_000:
                    known = {}
                texts = main_texts(batch.column("_html").to_pylist(), model, known)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return pages.select(id_col, F.col(url_col).cast("string").alias(url_col), F.col(html_col).cast("string").alias("_html")).mapInArrow(run, schema)
