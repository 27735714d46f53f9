"""Main text of web pages: the contiguous region of maximum score, words counting up and tags down."""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements that never hold an article's text.
NOISE = frozenset("nav footer aside form script style noscript template iframe object svg canvas button select option textarea input label fieldset dialog menu head title audio video".split())
#: Words of class, id or role that mark an element as no part of an article.
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion promoted cookie cookies consent gdpr notice notices alert alerts "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars rail footer foot masthead topbar toolbar header comment comments commentlist respond reply replies disqus "
    "share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay pagination pager search complementary contentinfo hidden".split()
)
#: Words that mark an element as part of a longer class name too, anywhere in it or at its end.
STRONG = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored cookie cookies gdpr breadcrumb breadcrumbs disqus newsletter".split())
LAST = frozenset("footer nav navbar navigation comments commentlist pagination".split())
COMMENTS = frozenset("comment comments commentlist respond reply replies disqus".split())
#: Elements without an end tag, elements whose content is raw text, and elements that end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: What an opening tag ends if it is still open.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

#: An attribute; a quote only opens a value after an equals sign, and only if it is closed.
_ATTRIBUTE = r"=?[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+"
TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE}|=)*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"(=?[^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+")


def _values(attributes: str) -> dict[str, str]:
    """Attributes by lower-case name; the first of equals counts."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _is_noise(name: str, attributes: dict[str, str], inside: set[str]) -> bool:
    if name in NOISE or name == "header" and not inside & {"article", "main"}:
        return True
    away = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in re.sub(r"\s", "", attributes.get("style", "").lower())
    return away and name not in ("html", "body", "article", "main")


def _marks(name: str, attributes: dict[str, str], inside: set[str]) -> set[str]:
    """The words of class, id or role that say that the element is no part of an article.

    A class name counts if all its words do, or one of STRONG or the last of LAST. Inside an article an id is mostly
    the name of a section, and a header holds the title.
    """
    found: set[str] = set()
    if not attributes or name in ("html", "body", "article", "main"):
        return found
    within = bool(inside & {"article", "main"})
    for attribute in ("class", "id", "role"):
        for each in attributes.get(attribute, "").lower().split():
            parts = [p for p in re.split(r"[^a-z]+", each) if p]
            if parts and parts[0] not in ("has", "no", "with", "without", "is"):
                of = set(parts) if NOISE_NAMES.issuperset(parts) else STRONG & set(parts) or LAST & {parts[-1]}
                if within:
                    of = of & (STRONG | COMMENTS) if attribute == "id" else of - {"header"}
                found |= of
    return found


def features(page: str) -> list[tuple[str, int, str]]:
    """(feature, how many, text) in page order: words, words in links, tags, and one item for each element of no interest.

    Inside an article or main element the feature begins with "in ". Comments, raw elements and elements of no interest
    are left out whole. The end tag of an element ends what was opened within it; an end tag without a start is
    ignored. A page may stop anywhere.

    An element that only its names mark stays for the scan if the article may lie inside it: if it holds an article or
    main element, or, on a page without any, an h1 or most of the words. Comments hold articles of their own, so they
    stay only with most of the words in articles, or an h1.
    """
    return [item[1:] for item in _placed(page)]


def _placed(page: str) -> list[tuple[int, str, int, str]]:
    """The features, each with its place in the page."""
    found: list[tuple[int, str, int, str]] = []
    open_: list[tuple[str, bool, int]] = []  # names, whether the element begins a stretch of no interest, and its place in marked
    marked: list[list] = []  # elements that only names mark: first item, one past the last, the names
    noisy, at, size = 0, 0, len(page)

    def within() -> str:
        return "in " if any(n in ("article", "main") for n, _, _ in open_) else ""

    def text(stop: int) -> None:
        if stop > at and not noisy:
            value = entities.unescape(page[at:stop])
            found.append((at, within() + ("link" if any(n == "a" for n, _, _ in open_) else "word"), len(value.split()), value))

    def leave() -> str:
        nonlocal noisy
        n, was, mark = open_.pop()
        noisy -= was
        if mark >= 0:
            marked[mark][1] = len(found)
        return n

    while at < size:
        start = page.find("<", at)
        m = TAG.match(page, start) if start >= 0 else None
        while start >= 0 and m is None:  # a lone <
            start = page.find("<", start + 1)
            m = TAG.match(page, start) if start >= 0 else None
        if m is None:
            text(size)
            break
        text(start)
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            before = noisy
            if any(n == name for n, _, _ in open_):
                while leave() != name:
                    pass
            if not before:
                found.append((start, f"{within()}/{name}", 1, ""))
            continue
        ends = CLOSES.get(name)
        while ends and open_ and open_[-1][0] in ends:
            leave()
        if name in RAW:
            stop = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*(?:>|\\Z)", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else size
            continue
        inside = {n for n, _, _ in open_}
        attributes = _values(m[3]) if m[3] else {}
        was = _is_noise(name, attributes, inside)
        names = set() if was or noisy else _marks(name, attributes, inside)
        if not noisy:
            found.append((start, within() + (f"skip {name}" if was else name), 1, ""))
        alone = name in VOID or m[3].rstrip().endswith("/")
        if names:
            marked.append([len(found) - 1, len(found) if alone else -1, names])
        if not alone:
            noisy += was
            open_.append((name, was, len(marked) - 1 if names else -1))
    return _without(found, [(a, len(found) if b < 0 else b, names) for a, b, names in marked]) if marked else found


def _without(found: list[tuple[int, str, int, str]], marked: list[tuple[int, int, set[str]]]) -> list[tuple[int, str, int, str]]:
    """found with one item in place of each element that its names mark and that can't hold the article."""
    words, core, articles, titles = [0], [0], [0], [0]  # running sums
    for _, feature, n, _ in found:
        counts = feature.endswith(("word", "link")) and feature.removeprefix("in ") in ("word", "link")
        words.append(words[-1] + n * counts)
        core.append(core[-1] + n * (counts and feature.startswith("in ")))
        articles.append(articles[-1] + (feature.removeprefix("in ") in ("article", "main")))
        titles.append(titles[-1] + (feature.removeprefix("in ") == "h1"))
    out, done = [], 0
    for a, b, names in marked:
        if a < done:
            continue  # inside one that is left out
        held = lambda sums: sums[b] - sums[a]  # noqa: B023, E731
        if articles[-1]:
            stays = held(articles) and (not names & COMMENTS or 2 * held(core) > core[-1])
        else:
            stays = held(titles) or 2 * held(words) > words[-1] and not names & COMMENTS
        if not stays:
            place, feature, n, text = found[a]
            prefix = "in " if feature.startswith("in ") else ""
            out += [*found[done:a], (place, f"{prefix}skip {feature.removeprefix('in ')}", n, text)]
            done = b
            if done < len(found) and found[done][1] == f"{prefix}/{feature.removeprefix('in ')}":
                done += 1
    return out + found[done:]


def region(found: list[tuple[str, int, str]], weights: dict[str, float]) -> tuple[int, int]:
    """First and one past last item of the contiguous run with the largest sum; the earliest and longest of equals.

    One scan: a running sum starts again where it has fallen below zero. (0, 0) if no word counts up.
    """
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    other = weights["other"]
    for i, (feature, n, _) in enumerate(found):
        if total < 0:
            total, start = 0.0, i
        total += n * weights.get(feature, other)
        if total > best or total == best and best > 0 and start == best_at[0]:
            best, best_at = total, (start, i + 1)
    return best_at


def labelled_pages(n: int = 240, seed: int = 7) -> list[list[tuple[str, int, bool]]]:
    """Labelled pages, made here: layouts of articles with menus, adverts and the like, each item marked as inside the article or not."""
    r = random.Random(seed)
    words = lambda a, b: " ".join("w" * r.randrange(2, 9) for _ in range(r.randrange(a, b)))
    pages = []
    for _ in range(n):
        menu = "<ul>" + "".join(f"<li><a href=x>{words(1, 3)}</a></li>" for _ in range(r.randrange(3, 9))) + "</ul>"
        before = [f"<header>{words(1, 6)}</header>", f"<nav>{menu}</nav>", f"<div class=menu>{menu}</div>", f"<div>{menu}</div>", f"<div class=ad>{words(3, 20)}</div>", f"<div class=cookie-notice>{words(5, 30)}</div>", f"<form><input>{words(1, 5)}</form>", f"<table><tr><td>{menu}</td></tr></table>"]
        after = [f"<footer>{words(3, 30)}</footer>", f"<aside>{words(5, 40)}</aside>", f"<section class=comments><h3>{words(1, 3)}</h3>" + "".join(f"<div class=comment><p>{words(4, 40)}</p></div>" for _ in range(3)) + "</section>", f"<div class=related>{menu}</div>", f"<div>{menu}</div>"]
        blocks = "".join(r.choice(["<p>{}</p>", "<aside>{}</aside>", "<div class=ad>{}</div>", "<ul><li>{}<li>w w w</ul>", "<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<p><b>{}</b><br></p>", "<ul><li>{}</li></ul>", "<blockquote><p>{}</p></blockquote>", "<p>{}<a href=x>w w</a></p>", "<table><tr><td>{}</td></tr></table>"]).format(words(4, 60)) for _ in range(r.randrange(1, 9)))
        inner = f"<h1>{words(2, 12)}</h1>" * r.randrange(2) + blocks
        left, right = r.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<div id=content>", "</div>"), ("<article>", "</article>")])
        r.shuffle(before)
        r.shuffle(after)
        head, tail = "<html><head><title>t</title></head><body>" + "".join(before[: r.randrange(1, 4)]) + left, right + "".join(after[: r.randrange(1, 4)]) + "</body></html>"
        page = head + inner + tail
        pages.append([(f, c, len(head) <= at < len(head + inner)) for at, f, c, _ in _placed(page)])
    return pages


def fit(pages: list[list[tuple[str, int, bool]]], rounds: int = 20) -> dict[str, float]:
    """Weights of words and tags by the averaged structured perceptron; words stay at 1, all others at -0.01 or below."""
    plain = ("word", "in word")
    weights = {f: (1.0 if f in plain else 0.2 if f.endswith("link") else -0.01) for page in pages for f, _, _ in page}
    total: Counter = Counter()
    for _ in range(rounds):
        for page in pages:
            start, stop = region([(f, n, "") for f, n, _ in page], weights | {"other": -0.05})
            change: Counter = Counter()
            for i, (f, n, inside) in enumerate(page):
                if (start <= i < stop) != inside and f not in plain:
                    change[f] += n if inside else -n
            for f, n in change.items():
                weights[f] = min(0.5 if f.endswith("link") else -0.01, weights[f] + 0.1 * max(-3, min(3, n)))
        total.update(weights)
    return {f: v / rounds for f, v in total.items()} | {"other": -0.05}


def main_text(page: str, weights: dict[str, float]) -> str:
    """The text of the best region: blocks in page order between two line feeds, white space inside a block one space."""
    found = features(page)
    start, stop = region(found, weights)
    blocks, parts = [], []
    for feature, _, text in [*found[start:stop], ("/body", 1, "")]:
        feature = feature.removeprefix("in ")
        if feature in ("word", "link"):
            parts.append(text)
        elif feature == "br":
            parts.append(" ")
        elif feature.lstrip("/").removeprefix("skip ") in BLOCKS:
            if block := " ".join("".join(parts).split()):
                blocks.append(block)
            parts = []
    return "\n\n".join(blocks)


def extract(pages: DataFrame, weights: dict[str, float] | None = None, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Returns key, url, text and n_chars for every page, from its whole html.

    Null or empty html, and a page without a word outside menus and the like, give an empty text. Rows stay apart
    however often they repeat; an empty table gives an empty result.
    """
    weights = weights or fit(labelled_pages())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h or "", weights) for h in b["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["key"], b["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["key", "url", "text", "n_chars"])

    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, url string, text string, n_chars long").withColumnRenamed("key", key)


def op2_pages(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
