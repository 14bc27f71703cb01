"""A tree-structured model over page nodes: sum-product message passing and training.

Every node is content or not. A node has a potential from its own features, an edge one from
the kind of the child. Messages go up from the deepest nodes and down again, for all nodes of
one depth in all pages of a batch at once; on a tree the marginals are exact. Training follows
the gradient of the labels' likelihood, observed minus expected counts, with the same messages.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np

from granary.llm.dom import Node

FEATURES = 1 << 12
KINDS = 3  # of edges, by the child: block, list or table part, text
_PARTS = frozenset("ul ol dl li dt dd table tbody tr td th".split())


def _slot(name: str) -> int:
    return crc32(name.encode()) % FEATURES


def features(node: Node, parent: Node | None) -> list[int]:
    names = [f"tag {node.tag}", *(f"word {w}" for w in node.words), *(f"begins {w[:5]}" for w in node.words)]
    if node.tag == "#text":
        names += [
            f"length {min(8, len(node.text).bit_length())}",
            f"linked {int(4 * node.linked)}",
            f"stop {node.text[-1] in '.!?:;,'}",
        ]
    if parent is not None:
        names.append(f"in {parent.tag} {node.tag}")
        names += [f"under {w[:5]}" for w in parent.words]
        if node.tag == "#text":
            names.append(f"in {parent.tag} linked {int(4 * node.linked)}")
    return [_slot(n) for n in names]


@dataclass
class Forest:
    """The trees of several pages; parents come before children, ``levels`` are nodes by depth."""

    parent: np.ndarray
    kind: np.ndarray
    owner: np.ndarray  # node of each entry of ``feature``
    feature: np.ndarray
    levels: list[np.ndarray]
    label: np.ndarray


def forest(pages: list[list[Node]]) -> Forest:
    parent, depth, kind, owner, feature, label = [], [], [], [], [], []
    for nodes in pages:
        base = len(parent)
        for node in nodes:
            k = len(parent)
            parent.append(node.parent + base if node.parent >= 0 else -1)
            depth.append(node.depth)
            kind.append(2 if node.tag == "#text" else 1 if node.tag in _PARTS else 0)
            found = features(node, nodes[node.parent] if node.parent >= 0 else None)
            feature += found
            owner += [k] * len(found)
            label.append(node.label)
    depths = np.array(depth, np.int64)
    order = np.argsort(depths, kind="stable")
    cuts = np.searchsorted(depths[order], np.arange(1, (depths.max() if len(depths) else 0) + 1))
    return Forest(
        np.array(parent, np.int64), np.array(kind, np.int64), np.array(owner, np.int64), np.array(feature, np.int64),
        np.split(order, cuts), np.array(label, np.int64),
    )


@dataclass
class Model:
    own: np.ndarray  # a weight of each feature for content
    edge: np.ndarray  # kind x parent's value x child's value

    def marginals(self, f: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Of every node: probabilities of both values, and of both values with its parent's."""
        n = len(f.parent)
        up = np.zeros((n, 2))
        up[:, 1] = np.bincount(f.owner, weights=self.own[f.feature], minlength=n)
        message = np.zeros((n, 2))
        edge = self.edge[f.kind]  # node x parent's value x own value
        for level in reversed(f.levels[1:]):
            message[level] = np.logaddexp.reduce(up[level][:, None, :] + edge[level], axis=2)
            np.add.at(up, f.parent[level], message[level])
        total, pairs = up.copy(), np.zeros((n, 2, 2))
        for level in f.levels[1:]:
            above = total[f.parent[level]] - message[level]  # the parent without this child
            joint = above[:, :, None] + edge[level] + up[level][:, None, :]
            total[level] = np.logaddexp.reduce(joint, axis=1)
            flat = joint.reshape(len(level), 4)
            pairs[level] = np.exp(flat - np.logaddexp.reduce(flat, axis=1)[:, None]).reshape(-1, 2, 2)
        return np.exp(total - np.logaddexp.reduce(total, axis=1)[:, None]), pairs


def train(f: Forest, steps: int = 250, rate: float = 0.15, decay: float = 1e-4) -> Model:
    """Ascent on the likelihood of the labels, with Adam's step sizes and a small decay."""
    model = Model(np.zeros(FEATURES), np.zeros((KINDS, 2, 2)))
    inner = np.flatnonzero(f.parent >= 0)
    seen = np.zeros((KINDS, 2, 2))
    np.add.at(seen, (f.kind[inner], f.label[f.parent[inner]], f.label[inner]), 1)
    wanted = np.bincount(f.feature, weights=f.label[f.owner], minlength=FEATURES)
    n = max(1, len(f.parent))
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in (model.own, model.edge)]
    for step in range(1, steps + 1):
        one, pairs = model.marginals(f)
        expected = np.zeros((KINDS, 2, 2))
        np.add.at(expected, f.kind[inner], pairs[inner])
        slopes = (
            (wanted - np.bincount(f.feature, weights=one[f.owner, 1], minlength=FEATURES)) / n - decay * model.own,
            (seen - expected) / n - decay * model.edge,
        )
        for weights, slope, (first, second) in zip((model.own, model.edge), slopes, moments):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            weights += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return model
