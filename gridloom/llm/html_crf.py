"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, each with its open
elements. Binary features of a block (ancestor tags, class and id words, length, links, punctuation, neighbours) and the
step from one block to the next carry weights, trained on labelled pages by maximising the
regularised likelihood; Viterbi's best sequence says which blocks are main text. Blocks that are
kept are kept whole.

The labelled pages of ``labelled_pages`` are made here from a number of page layouts, as no table holds
such labels; ``fit`` takes any others. Fitting is small and happens on the driver; pages are decoded in Spark tasks.

Defined cases: null and empty html, and pages without main text, give an empty text and 0; scripts, styles, the
head, comments and templates are never blocks; an unfinished tag at the end is dropped; text outside of
any element is a block; repeated rows are extracted each on its own; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import functools
import html as html_lib
import random
import re
from collections import Counter
from collections.abc import Callable, Container, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, table

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg math".split())
HIDDEN = frozenset(("head",))
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<[!?][^>]*(?:>|\Z)|</?[A-Za-z][^<>]*\Z""", re.S)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")
UNFINISHED = re.compile(r"<[!?]|</?[A-Za-z][^<>]*\Z")
STATES = 2


class Block:
    __slots__ = ("linked", "names", "tag", "text")

    def __init__(self, text: str, tag: str, names: frozenset[str], linked: int):
        self.text, self.tag, self.names, self.linked = text, tag, names, linked


def blocks(html: str | None, known: Container[str] | None = None) -> list[Block]:
    """The leaf blocks of a page, in page order. tag: of the innermost open element that is not inline; names: the features of
    the open elements' tags, classes and ids, only those that are ``known`` if given. Elements share their names with
    those inside that add none, so that depth costs nothing."""
    out: list[Block] = []
    stack: list[tuple[str, str, frozenset[str]]] = []
    opened: Counter[str] = Counter()
    run: list[tuple[str, bool]] = []
    hidden = links = 0
    html = html or ""
    stop = html.rfind(">") + 1  # nothing behind it is a finished tag
    if lost := UNFINISHED.search(html, stop):
        html = html[: lost.start()]

    def flush() -> None:
        text = " ".join("".join(x for x, _ in run).split())
        if text:
            _, tag, names = stack[-1] if stack else ("", "-", frozenset())
            out.append(Block(text, tag, names, sum(len(x.strip()) for x, a in run if a)))
        run.clear()

    def close(at: int) -> None:
        nonlocal hidden, links
        for tag, *_ in stack[at:]:
            hidden -= tag in HIDDEN
            links -= tag == "a"
            opened[tag] -= 1
        del stack[at:]

    at, n = 0, len(html)
    while at < n:
        found = TAG.search(html, at) if at < stop else None
        data = html[at : found.start() if found else n]
        if data and not hidden:
            run.append((html_lib.unescape(data), links > 0))
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if not found[1]:
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else n
                if tag not in INLINE:
                    flush()
                continue
            if tag == "br":
                run.append((" ", links > 0))
                continue
            if tag == "body":
                close(next((i for i, x in enumerate(stack) if x[0] in HIDDEN), len(stack)))
            if tag not in INLINE:
                flush()
            shut = CLOSES.get(tag, ()) if tag not in ENDS_P else {"p"}
            if shut:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in shut:
                        close(i)
                        break
                    if stack[i][0] not in INLINE and stack[i][0] != "p" or stack[i][0] in ("ul", "ol", "dl", "table"):
                        break
            if tag in VOID or found[3].endswith("/") and tag not in ENDS_P:
                continue
            _, last, names = stack[-1] if stack else ("", "-", frozenset())
            if tag not in INLINE:
                last = tag
                new = {f"in:{tag}", *(f"named:{w}" for m in NAMED.finditer(found[3]) for w in WORD.findall((m[1] or m[2] or m[3] or "").lower()))}
                new = new if known is None else {x for x in new if x in known}
                names = names if new <= names else names | new
            stack.append((tag, last, names))
            opened[tag] += 1
            hidden += tag in HIDDEN
            links += tag == "a"
        else:
            if tag not in INLINE:
                flush()
            for i in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[i][0] == tag:
                    close(i)
                    break
                if tag in INLINE and stack[i][0] not in INLINE:
                    break
    flush()
    return out


def features(page: Sequence[Block]) -> list[list[str]]:
    """Names of the binary features of each block."""
    out = []
    for i, b in enumerate(page):
        n, words = len(b.text), b.text.count(" ") + 1
        f = {"bias", *b.names, f"tag:{b.tag}", f"chars:{min(n.bit_length(), 11)}", f"words:{min(words.bit_length(), 8)}", f"links:{round(4 * min(1.0, b.linked / n))}"}
        if not b.names & {"in:article", "in:main"}:
            f.add("outside")
        ends = b.text[-1] in ".!?…\"'"
        f.add(f"ends:{ends}")
        f.add(f"stops:{min(3, sum(map(b.text.count, '.!?')))}")
        if b.text[0] in "©®" or "©" in b.text:
            f.add("copyright")
        if i == 0:
            f.add("first")
        if i == len(page) - 1:
            f.add("last")
        out.append(sorted(f))
    return out


def _page(rnd: random.Random) -> tuple[str, list[bool]]:
    """A page of random layout and the label of each of its blocks."""
    labels: list[bool] = []
    letters = ["an", "er", "on", "st", "the", "in", "ou", "re", "la", "de", "ung", "sch", "ión", "é", "que", "ti", "m", "k", "p"]
    word = lambda: "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 4)))

    def text(main: bool, low: int, high: int, stop: str = ".") -> str:
        labels.append(main)
        return " ".join(word() for _ in range(rnd.randint(low, high))).capitalize() + (stop if rnd.random() < 0.85 else "")

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="#">{text(False, 1, 3, "")}</a></li>' for _ in range(n)) + "</ul>"

    def box(kind: str) -> str:
        tag, names = {
            "ad": ("div", ("ad", "advert", "ads", "sponsored", "promo", "banner ad")), "notice": ("div", ("notice", "cookie notice", "consent", "alert", "banner", "gdpr")),
            "side": (rnd.choice(("aside", "div")), ("sidebar", "side", "widget", "related", "rail")), "share": ("div", ("share", "social", "tags", "breadcrumb", "meta")),
        }[kind]
        name = f' {rnd.choice(("class", "id"))}="{rnd.choice(names)}"' if tag != "aside" or rnd.random() < 0.5 else ""
        inner = links(rnd.randint(1, 5)) if kind in ("side", "share") and rnd.random() < 0.5 else (f"<p>{text(False, 2, 40)}</p>" * 1 if rnd.random() < 0.5 else text(False, 1, 30))
        return f"<{tag}{name}>{inner}</{tag}>"

    def form() -> str:
        what = rnd.choice(("search", "subscribe", "newsletter", "login"))
        out = f'<form class="{what}">'
        if rnd.random() < 0.6:
            out += f"<p>{text(False, 2, 15)}</p>"
        return out + f"<div><label>{text(False, 1, 3, '')}</label></div><div><button>{text(False, 1, 2, '')}</button></div></form>"

    def comments() -> str:
        name = rnd.choice(("comments", "comment", "commentlist", "responses", "replies"))
        tag = rnd.choice(("div", "section", "ol"))
        out = f'<{tag} {rnd.choice(("id", "class"))}="{name}">'
        if tag != "ol":
            out += f"<h3>{text(False, 1, 3, '')}</h3>"
        inner = "li" if tag == "ol" else "div"
        for _ in range(rnd.randint(1, 4)):
            out += f'<{inner} class="{rnd.choice(("comment", "reply"))}"><p>{text(False, 3, 60)}</p></{inner}>'
        return out + f"</{tag}>"

    def content() -> str:
        out = ""
        if rnd.random() < 0.9:
            out += f"<h1>{text(True, 2, 12, '')}</h1>"
        for _ in range(rnd.randint(1, 12)):
            kind = rnd.random()
            if kind < 0.62:
                a = f' <a href="#">{word()}</a> ' if rnd.random() < 0.2 else ""
                out += f"<p>{text(True, 1, rnd.choice((6, 40, 120)))}{a}</p>"
            elif kind < 0.72:
                out += f"<h{(h := rnd.randint(2, 4))}>{text(True, 1, 8, '')}</h{h}>"
            elif kind < 0.80:
                out += "<ul>" + "".join(f"<li>{text(True, 1, 20)}</li>" for _ in range(rnd.randint(1, 4))) + "</ul>"
            elif kind < 0.85:
                out += f"<blockquote>{text(True, 3, 40)}</blockquote>"
            elif kind < 0.89:
                out += f"<pre>{text(True, 2, 20)}</pre>"
            elif kind < 0.93:
                out += "<table>" + "".join(f"<tr><td>{text(True, 1, 4, '')}</td><td>{text(True, 1, 4, '')}</td></tr>" for _ in range(2)) + "</table>"
            elif kind < 0.97:
                out += box(rnd.choice(("ad", "share", "notice")))
            else:
                out += f"<figure><figcaption>{text(True, 2, 10)}</figcaption></figure>"
        return out

    out = "<body>"
    if rnd.random() < 0.15:  # main text alone
        tag = rnd.choice(("article", "main", "div", "section"))
        return f"<body><{tag}>" + "".join(f"<p>{text(True, 1, rnd.choice((6, 40, 120)))}</p>" for _ in range(rnd.randint(1, 4))) + f"</{tag}>", labels
    if rnd.random() < 0.3:
        out += box("notice")
    if rnd.random() < 0.5:
        out += f"<header>{f'<div>{text(False, 1, 4, str())}</div>' if rnd.random() < 0.7 else ''}<nav>{links(rnd.randint(2, 7))}</nav></header>"
    elif rnd.random() < 0.7:
        out += f"<nav>{links(rnd.randint(2, 7))}</nav>"
    else:
        out += f'<div class="{rnd.choice(("menu", "nav", "navbar", "header", "topbar"))}">{links(rnd.randint(2, 7))}</div>'
    for kind, p in (("ad", 0.6), ("share", 0.2)):
        if rnd.random() < p:
            out += box(kind)
    if rnd.random() < 0.2:
        out += form()
    wrap = rnd.choice(("<article>", "<article>", "<article>", "<main>", "<main><article>", '<div class="content">', '<div id="content">', '<div class="post">', '<div class="article body">', '<div class="entry">', '<section class="story">', '<div role="main">', "<div>"))
    shut = "".join(f"</{t}>" for t in re.findall(r"<(\w+)", wrap)[::-1])
    inner = content()
    if rnd.random() < 0.25:
        inner += comments()
    out += wrap + inner + shut
    for make, p in ((lambda: box("side"), 0.4), (comments, 0.25), (form, 0.2), (lambda: box("ad"), 0.2)):
        if rnd.random() < p:
            out += make()
    foot = f"&copy; {text(False, 1, 20)}"
    out += rnd.choice((f"<footer>{foot}</footer>", f"<footer><p>{foot}</p></footer>", f'<div class="footer">{foot}</div>'))
    return out + ("</body></html>" if rnd.random() < 0.9 else ""), labels


def labelled_pages(n: int = 400, seed: int = 7) -> list[tuple[list[Block], list[bool]]]:
    """Blocks and labels (main text or not) of pages of many layouts."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        html, labels = _page(rnd)
        found = blocks(html)
        assert len(found) == len(labels)
        out.append((found, labels))
    return out


class Crf:
    """Weights of features by state, and of steps from state to state."""

    def __init__(self, names: list[str], weights: np.ndarray, steps: np.ndarray):
        self.weights = dict(zip(names, weights.tolist(), strict=True))
        self.known = self.weights.keys() | {"in:article", "in:main"}
        self.steps = steps

    def scores(self, page: Sequence[Block]) -> np.ndarray:
        out = np.zeros((len(page), STATES))
        for row, names in zip(out, features(page), strict=True):
            for f in names:
                if (w := self.weights.get(f)) is not None:
                    row += w
        return out

    def decode(self, page: Sequence[Block]) -> list[int]:
        """Viterbi's best sequence of states."""
        scores, steps = self.scores(page).tolist(), self.steps.tolist()
        best, back = scores[0], []
        for row in scores[1:]:
            came = [max(range(STATES), key=lambda s: best[s] + steps[s][t]) for t in range(STATES)]
            best = [best[came[t]] + steps[came[t]][t] + row[t] for t in range(STATES)]
            back.append(came)
        s = max(range(STATES), key=lambda t: best[t])
        path = [s]
        for came in reversed(back):
            s = came[s]
            path.append(s)
        return path[::-1]


def fit(labelled: Sequence[tuple[Sequence[Block], Sequence[bool]]], rounds: int = 150, penalty: float = 0.02, rate: float = 0.3, at_least: int = 2) -> Crf:
    """Maximum regularised likelihood by forward-backward over all pages at once, with adaptive steps."""
    labelled = [x for x in labelled if x[0]]
    pages = [features(b) for b, _ in labelled]
    seen: dict[str, int] = {}
    for page in pages:
        for f in {f for row in page for f in row}:
            seen[f] = seen.get(f, 0) + 1
    names = sorted(f for f, k in seen.items() if k >= at_least)
    index = {f: i for i, f in enumerate(names)}
    sizes = np.array([len(p) for p in pages])
    starts = np.cumsum(sizes) - sizes
    row_of = np.array([r for r, row in enumerate(row for p in pages for row in p) for f in row if f in index])
    col_of = np.array([index[f] for p in pages for row in p for f in row if f in index])
    gold = np.array([int(y) for _, ys in labelled for y in ys])
    total, longest = int(sizes.sum()), int(sizes.max())
    weights, steps = np.zeros((len(names), STATES)), np.zeros((STATES, STATES))
    moves = np.zeros((STATES, STATES))
    inner = np.setdiff1d(np.arange(1, total), starts)
    np.add.at(moves, (gold[inner - 1], gold[inner]), 1)
    want = np.zeros((len(names), STATES))
    np.add.at(want, (col_of, gold[row_of]), 1)
    sums = [np.zeros_like(weights), np.zeros_like(steps)]

    def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)

    for _ in range(rounds):
        emit = np.zeros((total, STATES))
        np.add.at(emit, row_of, weights[col_of])
        ahead, behind = emit.copy(), np.zeros((total, STATES))
        for t in range(1, longest):
            at = starts[sizes > t] + t
            ahead[at] += log_sum(ahead[at - 1][:, :, None] + steps, 1)
        for t in range(longest - 2, -1, -1):
            at = starts[sizes > t + 1] + t
            behind[at] = log_sum(steps + (emit[at + 1] + behind[at + 1])[:, None, :], 2)
        z = np.repeat(log_sum(ahead[starts + sizes - 1], 1), sizes)
        prob = np.exp(ahead + behind - z[:, None])
        pair = np.exp(ahead[inner - 1][:, :, None] + steps + (emit[inner] + behind[inner])[:, None, :] - z[inner][:, None, None]).sum(0)
        got = np.zeros_like(weights)
        np.add.at(got, col_of, prob[row_of])
        for x, grad, s in zip((weights, steps), (want - got - penalty * weights, moves - pair - penalty * steps), sums, strict=True):
            s += grad**2
            x += rate * grad / (np.sqrt(s) + 1e-8)
    return Crf(names, weights, steps)


@functools.lru_cache(1)
def default_model() -> Crf:
    return fit(labelled_pages())


def main_text(html: str | None, model: Crf) -> str:
    page = blocks(html, model.known)
    return "\n".join(b.text for b, s in zip(page, model.decode(page), strict=True) if s) if page else ""


def extract(pages: DataFrame, model: Crf | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows (key, url, text string, n_chars long: its code points)."""
    model = model or default_model()

    def made() -> Callable[[str | None], list[tuple]]:
        return lambda x: [(found := main_text(x, model), len(found))]

    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"), F.col(html).alias("_html"))
    found = map_texts(rows, "_html", made, "text string, n_chars long", 1000)
    return found.select(F.col("_key").alias(key), F.col("_url").alias(url), "text", "n_chars")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
