"""The article of a page: blocks scored in one scan over its tags.

Runs of text between block tags score by length and commas, their container gets the score whole and each
container around it a share that falls with the distance. A container's score, its kind's weight added, is
cut by the share of its text inside links. The best container is the article, and siblings of its kind
that score like it belong to it. Inside the article, menus and blocks of links are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

TAG = re.compile(r"""<(/?)([A-Za-z][A-Za-z0-9-]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<[^>]*>""")
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
# Elements of the HTML standard that hold blocks, and those that only end one.
CONTAINERS = frozenset("address article aside blockquote body center dd div dl dt fieldset figure footer form header li main nav ol section "
                       "table tbody td th tr ul".split())
BREAKS = frozenset("br caption h1 h2 h3 h4 h5 h6 hr html option p pre".split())
WEIGHTS = {"article": 25, "main": 25, "section": 5, "div": 5, "td": 3, "blockquote": 3, "ul": -3, "ol": -3, "li": -3, "form": -10,
           "header": -10, "aside": -25, "nav": -50, "footer": -50}
LIKELY = re.compile(r"article|body|content|entry|main|page|post|story|text", re.I)
UNLIKELY = re.compile(r"\bads?\b|banner|breadcrumb|comment|cookie|foot|header|menu|nav|popup|promo|related|share|sidebar|social|sponsor|subscribe", re.I)
HINT = 25
LEAST_TEXT = 25  # shorter runs carry no score
LIKE = 0.2  # of the best score
LEAST_LIKE = 10.0


class Node:
    """A container: places of its content, its text and link lengths, and the scores that reached it."""

    __slots__ = ("name", "parent", "start", "end", "text", "links", "score", "weight")

    def __init__(self, name: str, parent: Node | None, start: int, attributes: str = ""):
        self.name, self.parent, self.start, self.end = name, parent, start, start
        self.text = self.links = 0
        self.score = 0.0
        self.weight = WEIGHTS.get(name, 0)
        if attributes:
            hints = " ".join("".join(found) for found in NAMED.findall(attributes))
            self.weight += (HINT if LIKELY.search(hints) else 0) - (HINT if UNLIKELY.search(hints) else 0)

    def link_share(self) -> float:
        return self.links / self.text if self.text else 0.0

    def total(self) -> float:
        return (self.score + self.weight) * (1.0 - self.link_share()) if self.score else 0.0


def containers(page: str) -> list[Node]:
    """Containers in the order they open, the page itself first; one scan, end tags nobody opened are skipped."""
    root = Node("", None, 0)
    nodes, stack, open_names = [root], [root], {}
    run = linked = 0
    commas, in_link, at = 0, False, 0

    def close_run():
        nonlocal run, linked, commas
        if run - linked >= LEAST_TEXT:
            node, gain = stack[-1], 1.0 + commas + min((run - linked) // 100, 3)
            for distance in range(len(stack)):
                node.score += gain / (distance * (distance + 1)) if distance else gain
                node = node.parent
                if node is None or distance == 3:
                    break
        run = linked = commas = 0

    def close_node(end: int):
        node = stack.pop()
        open_names[node.name] -= 1
        node.end = end
        node.parent.text += node.text
        node.parent.links += node.links

    for tag in TAG.finditer(page):
        if tag.start() > at:
            text = page[at:tag.start()]
            n = len(text.strip())
            run, commas = run + n, commas + text.count(",")
            stack[-1].text += n
            if in_link:
                linked += n
                stack[-1].links += n
        at = tag.end()
        name = (tag[2] or "").lower()
        if name == "a":
            in_link = not tag[1]
        elif name in BREAKS:
            close_run()
        elif name in CONTAINERS:
            close_run()
            if not tag[1]:
                stack.append(Node(name, stack[-1], at, tag[3]))
                open_names[name] = open_names.get(name, 0) + 1
                nodes.append(stack[-1])
            elif open_names.get(name):
                while stack[-1].name != name:
                    close_node(tag.start())
                close_node(tag.start())
    n = len(page[at:].strip())
    run += n
    stack[-1].text += n
    close_run()
    while len(stack) > 1:
        close_node(len(page))
    root.end = len(page)
    return nodes


def article_html(page: str | None) -> str | None:
    """Content of the article's containers; without any scored text, the page without its menus."""
    if page is None:
        return None
    nodes = containers(page)
    best = max(nodes, key=Node.total)  # of equal ones the first, which is the outer one
    if best.total() <= 0:
        chosen = [nodes[0]]
    else:
        enough = max(LEAST_LIKE, LIKE * best.total())
        chosen = [n for n in nodes if n is best or (n.parent is best.parent and n.name == best.name and n.total() >= enough)]
    parts = []
    for piece in chosen:
        at = piece.start
        for node in nodes:
            if at <= node.start < piece.end and node is not piece and _is_menu(node):
                opening = page.rfind("<", 0, node.start)
                parts.append(page[at:opening])
                at = node.end
        parts.append(page[at:piece.end])
        parts.append("<br>")
    return "".join(parts[:-1])


def _is_menu(node: Node) -> bool:
    return node.weight < -HINT // 2 or (node.links > 0 and node.link_share() > 0.5)


@F.pandas_udf(StringType())
def _article(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(article_html, na_action="ignore")


def article_of(page: Column) -> Column:
    return _article(page)
