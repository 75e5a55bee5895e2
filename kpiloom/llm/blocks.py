"""HTML as a sequence of text blocks, each with the tags that it stands in.

A block is the text between two block-level tags; white space in it is one
space, character references are decoded. Elements that hold no text of the
page (scripts, styles, titles, templates, form controls) give no blocks. Without
its end tag a template or an element of raw text goes to the end of the page,
another to the end of the block or link around it, and svg and math at most to
the next block; one of these that its tag closes ("/>") is empty. An inline
element that is hidden or styled not to be shown is silent in the same way. A head has no
text of its own: what stands in it is silent or, as in browsers, of the body.
A tag that the end of the page cuts off is markup.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# --- Fixed values of HTML ---
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = ("script", "style", "title", "noscript", "textarea", "iframe")
SILENT_TAGS = frozenset("template select button svg math object canvas audio video".split())
# --- end of fixed values ---
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                    r"""|<(?P<silent>""" + "|".join(RAW_TAGS) + r""")(?=[\s/>])[^>]*>(?:.*?</(?P=silent)\s*>|.*\Z)"""
                    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+(?:>|\Z)|[^>]*(?:>|\Z))|</[^>]*(?:>|\Z)""", re.I | re.S)
_NAMES = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
_ATTRIBUTES = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPLIT = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Block:
    text: str
    path: tuple[str, ...]  # tags and the words of their class, id and role, outermost first; the innermost tag again as "in:tag"
    linked: int  # characters in links


def names_of(tag: str, rest: str) -> tuple[str, ...]:
    """A tag with the words that its attributes say about it."""
    out = [tag]
    if "=" in rest or "hidden" in rest:
        for key, *values in _NAMES.findall(rest):
            key, value = key.lower(), "".join(values)
            if key == "style":
                out += ["is:hidden"] * bool(_NOT_SHOWN.search(value))
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                out.append("is:hidden")
            elif key in ("class", "id", "role"):
                out += [f".{w.lower()}" for w in _WORDS.findall(value)]
    return tuple(out)


def unseen(rest: str) -> bool:
    """Whether an inline element's attributes say that it is not shown."""
    if "hidden" not in rest.lower() and "display" not in rest.lower():
        return False
    return any(key.lower() == "hidden" or key.lower() == "style" and _NOT_SHOWN.search(value) for key, value in _ATTRIBUTES.findall(rest))


def blocks_of(page: str) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links, linked, at = 0, 0, 0
    silent, depth, inside = "", 0, []  # the silent element that is open, how often, and the blocks and links opened in it

    def text(piece: str) -> None:
        nonlocal linked
        if piece and not silent:
            parts.append(piece)
            if links:
                linked += len(piece)

    def flush() -> None:
        nonlocal linked
        if parts:
            whole = " ".join(html.unescape("".join(parts)).split())
            if whole:
                path = tuple(name for _, names in stack for name in names)
                out.append(Block(whole, (*path, "in:" + (stack[-1][0] if stack else "none")), linked))
            parts.clear()
        linked = 0

    for token in _TOKEN.finditer(page):
        text(page[at:token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if silent:
            foreign = silent in ("svg", "math")
            if tag == silent:
                if token["end"]:
                    depth -= 1
                elif tag not in ("select", "button") and not token["rest"].endswith("/>"):
                    depth += 1
                if not depth:
                    silent = ""
                continue
            if token["end"] and tag in inside:
                while inside.pop() != tag:
                    pass
                continue
            if token["end"]:
                ends = silent != "template" and (tag == "a" and links or any(t == tag for t, _ in stack))
            else:
                ends = foreign and tag in BLOCK_TAGS and "foreignobject" not in inside
            if not ends:
                if not token["end"] and (tag in BLOCK_TAGS or tag in ("a", "foreignobject")) and tag not in VOID_TAGS and not token["rest"].endswith("/>"):
                    inside.append(tag)
                continue
            silent = ""
        if tag in SILENT_TAGS:
            if not token["end"] and not token["rest"].endswith("/>"):
                silent, depth, inside = tag, 1, []
        elif tag == "br":
            parts.append("\n")
        elif tag == "a":
            links = 0 if token["end"] else 1
        elif tag in BLOCK_TAGS:
            flush()
            links = 0
            if token["end"]:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == tag:
                        del stack[depth:]
                        break
            else:
                # A new one of these ends an open one of its kind; any block ends a paragraph.
                if stack and (stack[-1][0] == "p" or stack[-1][0] == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option")):
                    stack.pop()
                if tag not in VOID_TAGS:
                    stack.append((tag, names_of(tag, token["rest"])))
        elif not token["end"] and tag not in VOID_TAGS and not token["rest"].endswith("/>") and unseen(token["rest"]):
            silent, depth, inside = tag, 1, []
    text(page[at:])
    flush()
    return out
