"""Main text of web pages by two passes over their blocks.

The first pass classifies blocks by length, link density and stop-word density: long
blocks with stop words are good, blocks of links bad, short ones undecided. In the second,
undecided blocks take the label of the decided neighbour fewest blocks away, good on a tie; inside the article one good
neighbour is enough. An unclosed head ends at the first body element, another unclosed element without text at its parent's end, or
before the next block where the parent is an article or the page. Blocks in menus, headers, footers, sidebars, forms, notices, adverts and
comments of readers are bad whatever they hold, by element or by class and id words. A page with a quote that never ends in a tag
is read without regard to quotes from there on; a second head is none.

Null and empty pages have no text. Repeated rows get equal texts. Stop words are the
words held by the most pages, learnt from the whole table. Other columns are kept; text and n_chars
are replaced.
"""

import html as entities
from bisect import bisect_left
from collections import Counter

import pandas as pd
import regex
from pyspark.sql import functions as F

from .common import table

LONG = 60
LINKS = 0.33
STOP_DENSITY = 0.08
STOP_WORDS = 200

# Elements whose text is no article text, elements that never hold text, block elements.
OUTSIDE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu"}
SILENT = {"script", "style", "noscript", "template", "iframe", "svg", "head", "textarea", "object"}
BLOCKS = {"p", "div", "article", "section", "main", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "table", "tr",
          "td", "th", "blockquote", "pre", "dl", "dt", "dd", "figure", "figcaption", "header", "body", "html", "hr", "br"} | OUTSIDE
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
_MARKS = (r"ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|side-?bar|footer|header|masthead|breadcrumbs?|cookies?|"
          r"consent|notice|popup|modal|newsletter|subscribe|share|social|related|comments?|replies|disqus|widget")
MARKED = regex.compile(rf"(^|[\s_\-])({_MARKS})($|[\s_\-])")
# Inside the article, elements of prose are bad by a whole class word only: share-price is no share.
MARKED_WHOLE = regex.compile(rf"(?<!\S)({_MARKS})(?!\S)")
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figure", "figcaption", "td", "th", "dt", "dd", "table", "tr"}

_COMMENT, _SECTION, _MARK = r"<!--.*?(?:-->|$)|", r"<!\[CDATA\[.*?\]\]>|", r"<[!?][^>]*>|"
# A tag that never ends, as a quote stays open, is the last alternative; from there on quotes have no meaning.
_QUOTED = r"<(/?)([A-Za-z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|(?P<open><(?=/?[A-Za-z]))"
_PLAIN = r"<(/?)([A-Za-z][\w:-]*)([^<>]*)>(?P<open>(?!))?"
# By whether quotes have a meaning and whether a section still ends.
_TAGS = {(quoted, sections): regex.compile(
    _COMMENT + (_SECTION if sections else "") + _MARK + (_QUOTED if quoted else _PLAIN), regex.S)
    for quoted in (True, False) for sections in (True, False)}
_SILENT_ENDS = {name: regex.compile(rf"</{name}\b[^>]*>", regex.I) for name in SILENT}
_HEAD_NAMES = "title|script|style|noscript|template"
_HEAD = regex.compile(
    rf"(?:[^<]++|<!--.*?-->|<[!?][^>]*>|<({_HEAD_NAMES})\b[^>]*>.*?</\1\s*>|</?(?:base|link|meta|basefont|bgsound)\b[^>]*>)*+", regex.S | regex.I)
_HEAD_END = regex.compile(rf"</head\b[^>]*>|<(?!(?:{_HEAD_NAMES}|base|link|meta|basefont|bgsound)\b)[a-z]", regex.S | regex.I)
# Elements that may leave out their end tags; elements whose content is no markup; elements that hold a whole page's text.
OPEN_ENDED = {"p", "li", "tr", "td", "th", "dt", "dd"}
RAW = {"script", "style", "textarea", "iframe"}
WIDE = {None, "html", "body", "main", "article", "section"}
_NAMED = regex.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", regex.I)
_WORDS = regex.compile(r"\p{L}+")
_SPACE = regex.compile(r"\s+")


class _Tags:
    """The tags of one page from any place on. What a search of the rest of the page found out is kept, so that a page is
    passed over a fixed number of times, whatever its markup."""

    def __init__(self, page):
        self.page, self.quoted, self.ends = page, True, {}
        self.last = page.rfind(">")
        # A section that never ends is a mark up to the next sign.
        self.sections = page.rfind("]]>")

    def after(self, position, end):
        """The next tag before `end`, or None."""
        while position < end:
            if position > self.last:
                # No tag ends any more; a comment runs to the end of the page.
                start = self.page.find("<!--", position, end)
                return _TAGS[False, False].match(self.page, start, end) if start >= 0 else None
            match = _TAGS[self.quoted, position <= self.sections].search(self.page, position, end)
            if match and match.group("open"):
                self.quoted, position = False, match.start()
                continue
            return match
        return None

    def silent_end(self, name, position):
        """The end tag of a silent element after a place; each is sought once."""
        if name not in self.ends or self.ends[name] and self.ends[name].start() < position:
            self.ends[name] = _SILENT_ENDS[name].search(self.page, position)
        return self.ends[name]


def _silent_end(tags, position, name, parent):
    """Where a silent element ends: after its end tag, or at its parent's end if that comes first."""
    page, finish = tags.page, tags.silent_end(name, position)
    if name == "head":
        start = _HEAD.match(page, position).end()
        limit = _HEAD_END.search(page, start)
        if limit:
            return limit.end() if limit.group().startswith("</") else limit.start()
        return finish.end() if finish else position
    if finish and name in RAW:
        return finish.end()
    depth, at, end = 0, position, finish.start() if finish else len(page)
    while tag := tags.after(at, end):
        at = tag.end()
        closing, inner = tag.group(1), (tag.group(2) or "").lower()
        if not finish and not closing and inner in BLOCKS and not depth and (
                name == "svg" or parent in WIDE or parent == "p" or (inner == parent and inner in OPEN_ENDED)):
            return tag.start()
        if inner in VOID or tag.group(3) and tag.group(3).endswith("/") or not (
                inner == parent or inner in BLOCKS and inner not in OPEN_ENDED):
            continue
        if not closing:
            depth += 1
        elif depth:
            depth -= 1
        else:
            return tag.start()
    return finish.end() if finish else len(page)


def blocks(page):
    """Blocks of a page in order: text, characters in links, whether it lies in an outside element, in a heading."""
    out, parts, links, stack = [], [], 0, []
    position, end, tags, opened, headed = 0, len(page), _Tags(page), Counter(), False

    def inside():
        """Whether the open elements include a bad one, an article, a main part or article, a link."""
        return stack[-1][1:] if stack else (False, False, False, False)

    def close():
        nonlocal parts, links
        text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        if text:
            bad, _, main, _ = inside()
            out.append((text, links, bad, main))
        parts, links = [], 0

    def take(piece):
        nonlocal links
        parts.append(piece)
        if inside()[3]:
            links += len(piece.strip())

    while position < end:
        match = tags.after(position, end)
        if not match:
            take(page[position:])
            break
        if match.start() > position:
            take(page[position:match.start()])
        position = match.end()
        closing, name, attributes = match.group(1), (match.group(2) or "").lower(), match.group(3) or ""
        if not name:
            continue
        if name == "head" and not closing:
            if headed:
                continue
            headed = True
        if name in SILENT and not closing:
            if name in BLOCKS:
                close()
            if not attributes.endswith("/"):
                position = _silent_end(tags, position, name, stack[-1][0] if stack else None)
            continue
        if name in BLOCKS and name != "br":
            close()
        elif name == "br":
            parts.append(" ")
        if closing:
            while opened[name]:
                opened[stack[-1][0]] -= 1
                if stack.pop()[0] == name:
                    break
        elif name not in VOID and not attributes.endswith("/"):
            if name in ("p", "li", "tr", "td") and stack and stack[-1][0] == name:
                opened[stack.pop()[0]] -= 1
            marks = " ".join(next(g for g in m if g is not None and g != "") if any(m) else "" for m in _NAMED.findall(attributes)).lower()
            outer_bad, in_article, in_main, in_link = inside()
            bad = outer_bad or name in OUTSIDE or (name == "header" and not in_main) or (
                name not in ("html", "body", "article", "main") and bool(
                    (MARKED_WHOLE if in_main and name in PROSE else MARKED).search(marks)))
            opened[name] += 1
            stack.append((name, bad, in_article or name == "article", in_main or name in ("article", "main"),
                          in_link or name == "a"))
    close()
    return out


def main_text(page, stop_words):
    found = blocks(page)
    labels = []
    for text, links, outside, _ in found:
        held = [w.lower() for w in _WORDS.findall(text)]
        density = sum(w in stop_words for w in held) / max(len(held), 1)
        if outside:
            labels.append("outside")
        elif links / len(text) > LINKS:
            labels.append("bad")
        elif len(text) >= LONG and (density >= STOP_DENSITY or len(text) >= 3 * LONG):
            labels.append("good")
        else:
            labels.append("short")
    decided = [i for i, l in enumerate(labels) if l != "short"]
    final = []
    for i, label in enumerate(labels):
        if label == "short":
            sides = [d for d in (_nearest(decided, i, -1), _nearest(decided, i, 1)) if d is not None]
            least = min((abs(d - i) for d in sides), default=0)
            near = [labels[d] for d in sides]
            inside = found[i][3]
            label = "good" if (inside and ("bad" not in near or "good" in near)) or (
                not inside and any(labels[d] == "good" and abs(d - i) == least for d in sides)) else "bad"
        final.append(label)
    return "\n".join(b[0] for b, label in zip(found, final) if label == "good")


def _nearest(decided, i, side):
    at = bisect_left(decided, i)
    if side < 0:
        return decided[at - 1] if at else None
    return decided[at] if at < len(decided) else None


def learnt_stop_words(pages, size=STOP_WORDS):
    """The words of the most pages, markup aside; at most `size` come to the driver."""
    text = F.regexp_replace(F.coalesce("html", F.lit("")), "<[^>]*>", " ")
    held = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0)))
    counted = pages.select(F.explode(held).alias("word")).groupBy("word").count()
    return {r["word"] for r in counted.orderBy(F.desc("count"), "word").limit(size).collect()}


def extract(pages):
    """Adds text and n_chars to rows with html."""
    stop_words = learnt_stop_words(pages)
    kept = pages.drop("text", "n_chars")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def build(batches):
        for batch in batches:
            batch["text"] = pd.Series([main_text(h or "", stop_words) for h in batch["html"]], dtype=object, index=batch.index)
            yield batch

    return kept.mapInPandas(build, f"{types}, text string").withColumn("n_chars", F.length("text").cast("long"))


def op6_html_text(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
