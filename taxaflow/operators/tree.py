"""Neighbour-joining trees of aligned sequences in chunks, and what their clades say."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.functions.ordering import row_number


def chunk(seqs: DataFrame, size: int = 50) -> DataFrame:
    """Adds chunk: sequences in order (ord), ``size`` in each."""
    return row_number(seqs, [F.col("ord").asc(), F.col("id").asc()], "_i").withColumn("chunk", F.expr(f"cast((_i - 1) div {size} as int)")).drop("_i")


def identity_distances(seqs: list[str]) -> np.ndarray:
    """1 - the share of equal columns of aligned sequences (shorter ones count as gaps)."""
    width = max(map(len, seqs), default=0)
    x = np.array([[ord(c) for c in s.ljust(width, "-")] for s in seqs], np.int32).reshape(len(seqs), width)
    return np.array([(x != r).sum(1) for r in x], float) / max(width, 1)


class Node:
    __slots__ = ("name", "children", "up", "length")

    def __init__(self, name: str = "", children=()):
        self.name, self.children, self.up, self.length = name, list(children), None, 0.0
        for c in self.children:
            c.up = self

    def leaves(self) -> list[str]:
        out, todo = [], [self]
        while todo:
            n = todo.pop()
            todo += n.children
            if not n.children:
                out.append(n.name)
        return sorted(out)

    def newick(self) -> str:
        inner = f"({','.join(c.newick() for c in self.children)})" if self.children else self.name
        return f"{inner}:{self.length:.6f}" if self.up is not None else f"{inner};"


def neighbour_joining(names: list[str], d: np.ndarray) -> Node:
    nodes, d = [Node(n) for n in names], d.astype(float).copy()
    while len(nodes) > 2:
        n, total = len(nodes), d.sum(1)
        q = (n - 2) * d - total[:, None] - total[None, :]
        np.fill_diagonal(q, np.inf)
        i, j = sorted(divmod(int(q.argmin()), n))
        a, b = nodes[i], nodes[j]
        a.length = d[i, j] / 2 + (total[i] - total[j]) / (2 * (n - 2))
        b.length = d[i, j] - a.length
        new = (d[i] + d[j] - d[i, j]) / 2
        rest = [k for k in range(n) if k not in (i, j)]
        d = np.block([[d[np.ix_(rest, rest)], new[rest][:, None]], [new[rest][None, :], np.zeros((1, 1))]])
        nodes = [nodes[k] for k in rest] + [Node(children=[a, b])]
    if len(nodes) == 2:
        nodes[0].length = nodes[1].length = d[0, 1] / 2
        return Node(children=nodes)
    return nodes[0] if nodes else Node()


def root_at(tree: Node, name: str) -> Node:
    """The tree with the branch of a leaf split by a new root; unchanged without that leaf."""
    at = next((n for n in _nodes(tree) if not n.children and n.name == name), None)
    if at is None or at.up is None:
        return tree
    chain = []
    n = at.up
    while n is not None:
        chain.append(n)
        n = n.up
    length, below = at.length / 2, at
    at.up.children.remove(at)
    previous, carried = None, length
    for n in chain:  # turn the path to the old root round
        up, own = n.up, n.length
        if up is not None:
            up.children.remove(n)
        if previous is not None:
            previous.children.append(n)
        n.up, n.length = previous, carried
        previous, carried = n, own
    for n in chain:
        while len(n.children) == 1 and n.up is not None:  # the old root may be left with one child
            child = n.children[0]
            child.length += n.length
            child.up = n.up
            n.up.children[n.up.children.index(n)] = child
            n.children = []
    top = chain[0]
    below.length, top.length = length, length
    return Node(children=[below, top])


def _nodes(tree: Node) -> list[Node]:
    out, todo = [], [tree]
    while todo:
        n = todo.pop()
        out.append(n)
        todo += n.children
    return out


def common_ancestor(tree: Node, names: set[str]) -> Node | None:
    """The smallest clade with all of the named leaves that the tree has."""
    have = names & set(tree.leaves())
    if not have:
        return None
    return min((n for n in _nodes(tree) if have <= set(n.leaves())), key=lambda n: len(n.leaves()))


def classify(seqs: DataFrame, targets: DataFrame, outgroup: str | None = None) -> DataFrame:
    """(chunk, newick, ph, pph): for each chunk (chunk, id, seq), a tree with the targets and, if given, the outgroup as root.

    ph are the leaves of the smallest clade with all targets, pph the other ones; targets and outgroup are left out of
    both. Targets (id, seq; the outgroup among them) are references and join every chunk.
    """
    refs = [(r["id"], r["seq"]) for r in targets.orderBy("id").collect()]
    controls = {i for i, _ in refs}

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        own = sorted((i, s) for i, s in zip(pdf["id"], pdf["seq"]) if i not in controls)
        names, texts = zip(*[*refs, *own]) if refs or own else ((), ())
        tree = neighbour_joining(list(names), identity_distances(list(texts)))
        if outgroup:
            tree = root_at(tree, outgroup)
        clade = common_ancestor(tree, controls - {outgroup})
        inside = set(clade.leaves()) if clade else set()
        ph = sorted(n for n, _ in own if n in inside)
        return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "newick": [tree.newick()], "ph": [ph], "pph": [sorted(n for n, _ in own if n not in inside)]})

    return seqs.groupBy("chunk").applyInPandas(one, "chunk int, newick string, ph array<string>, pph array<string>")


def find_tip(names: list[str], wanted: str) -> str:
    """The tip of that name, else the only one that contains it (case ignored)."""
    if wanted in names:
        return wanted
    found = [n for n in names if wanted.lower() in n.lower()]
    if len(found) != 1:
        raise ValueError(f"{len(found)} tips match {wanted!r}")
    return found[0]
