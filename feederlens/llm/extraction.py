"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a variable, article or not. What is observed
of it (kind of tag, words of class, id and role, share of linked text, size,
sentence marks) depends on its state, and its state on its parent's and on the
kind of tag that leads there. The page as a whole is the root, article itself
where the text stands right in the body; text between blocks is a block. Sum-product messages go from the leaves to the root
and back, which gives every element's exact marginal; the text of the blocks
whose element is more likely article than not is the page's main text. The
tables are counted, with add-one smoothing, on the labelled pages of
``html_labels``; they are small and fitted once, on the driver.

A page is judged by itself: null, empty or textless html gives an empty text,
repeated rows repeat the answer, other columns are left alone, and an empty
table gives an empty result. Unclosed and stray tags are taken as browsers do.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feederlens.llm.html_labels import labelled_pages
from feederlens.llm.html_tree import Node, Tree, features

#: Observations are not independent of each other; each counts for so much.
TEMPER = 0.85
SMOOTH = 0.5


class TreeModel:
    """Log tables: of the root, of a child's state by its parent's and its tag, of observations by state."""

    def __init__(self, pages: list[str]):
        seen: Counter = Counter()
        states: Counter = Counter()
        roots: Counter = Counter()
        kinds: dict[int, set[str]] = {}
        moves: Counter = Counter()
        for html in pages:
            tree = Tree(html)
            label = {id(tree.root): tree.root.label or 0}
            roots[label[id(tree.root)]] += 1
            observed = features(tree.nodes)
            for node, values in zip(tree.nodes, observed, strict=True):
                if node.parent is not None:
                    state = node.label if node.label is not None else label[id(node.parent)]
                    label[id(node)] = state
                    moves[label[id(node.parent)], values[0], state] += 1
                state = label[id(node)]
                states[state] += 1
                for i, value in enumerate(values):
                    seen[state, value] += 1
                    kinds.setdefault(i, set()).add(value)
        #: The root is article where a page's text stands right in its body.
        self.root = [log((roots[s] + SMOOTH) / (len(pages) + 2 * SMOOTH)) for s in (0, 1)]
        self.moves = {}
        tags = kinds[0]
        for parent in (0, 1):
            every = [sum(moves[parent, t, s] for t in tags) + SMOOTH for s in (0, 1)]
            for tag in [*tags, None]:
                # Tags seen seldom lean on what all tags do.
                got = [moves[parent, tag, s] + 2 * every[s] / sum(every) for s in (0, 1)]
                self.moves[parent, tag] = [log(g / sum(got)) for g in got]
        self.seen = {}
        for values in kinds.values():
            for value in values:
                self.seen[value] = [
                    TEMPER * log((seen[s, value] + SMOOTH) / (states[s] + SMOOTH * (len(values) + 1))) for s in (0, 1)
                ]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of being article for each node, parents before children in ``nodes``."""
        observed = features(nodes)
        place = {id(n): i for i, n in enumerate(nodes)}
        none = [0.0, 0.0]
        # Tag kinds act through the moves alone.
        own = [[sum(self.seen.get(v, none)[s] for v in values[1:]) for s in (0, 1)] for values in observed]
        moves = [
            [self.moves.get((s, values[0])) or self.moves[s, None] for s in (0, 1)] for values in observed
        ]
        below = [list(o) for o in own]
        message = [none] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            message[i] = [_sum(moves[i][s][0] + below[i][0], moves[i][s][1] + below[i][1]) for s in (0, 1)]
            parent = below[place[id(nodes[i].parent)]]
            parent[0] += message[i][0]
            parent[1] += message[i][1]
        above = [self.root] + [none] * (len(nodes) - 1)
        found = [0.0] * len(nodes)
        for i in range(len(nodes)):
            if i:
                at = place[id(nodes[i].parent)]
                rest = [above[at][s] + below[at][s] - message[i][s] for s in (0, 1)]
                above[i] = [_sum(rest[0] + moves[i][0][s], rest[1] + moves[i][1][s]) for s in (0, 1)]
            zero, one = (above[i][s] + below[i][s] for s in (0, 1))
            found[i] = 1 / (1 + exp(min(700.0, zero - one)))
        return found


def _sum(a: float, b: float) -> float:
    """Logarithm of the sum of two exponentials."""
    high, low = (a, b) if a > b else (b, a)
    return high + log(1 + exp(low - high)) if low > high - 40 else high


_MODEL: list[TreeModel] = []


def model() -> TreeModel:
    if not _MODEL:
        _MODEL.append(TreeModel(labelled_pages()))
    return _MODEL[0]


def main_text(html: str | None, fitted: TreeModel | None = None) -> str:
    if not html:
        return ""
    tree = Tree(html)
    blocks = tree.texts()
    if not blocks:
        return ""
    chance = dict(zip(map(id, tree.nodes), (fitted or model()).marginals(tree.nodes), strict=True))
    return "\n".join(text for node, text in blocks if chance[id(node)] > 0.5)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` of the main text of ``html``; columns of these names are replaced."""
    pages = pages.drop("text", "n_chars")
    schema = pages.select("*", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    # Some hundred numbers, fitted here and sent with the task.
    fitted = model()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, fitted) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=schema.names,
            )

    return pages.mapInArrow(extracted, schema)
