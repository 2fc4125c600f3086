"""Prefix tree of ordered sets, searched for sets above a Jaccard similarity."""

from __future__ import annotations

from bisect import bisect_right

# Tokens on an edge are compared in runs of this length, so that a hopeless branch ends early.
_STEP = 32


class _Node:
    __slots__ = ("tokens", "steps", "children", "owner", "least", "most")

    def __init__(self, tokens: list[int], owner: int | None, size: int):
        self.children: dict[int, _Node] = {}
        self.owner, self.least, self.most = owner, size, size
        self.edge(tokens)

    def edge(self, tokens: list[int]) -> None:
        self.tokens = tokens
        self.steps = [(frozenset(tokens[i : i + _STEP]), tokens[min(i + _STEP, len(tokens)) - 1]) for i in range(0, len(tokens), _STEP)]


class SimilarSets:
    """Links between the sets of one group, one tree path per set.

    Sets are strictly ascending token lists in one global order. ``percent``: sets link when
    100 * intersection >= percent * union. Sets already known to be connected are not compared
    again; so the links found connect what is similar, with at most one link per join of classes.
    """

    def __init__(self, percent: int = 80):
        self.percent = percent
        self.root = _Node([], None, 0)
        self.root.least = 1 << 60
        self.sizes: list[int] = []
        self.parent: list[int] = []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def _needed(self, a: int, b: int) -> int:
        """Least overlap of linked sets of sizes a and b."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def add(self, tokens: list[int], known: int | None = None) -> list[int]:
        """Insert a set; return the indexes of sets it links with that weren't connected with it.

        ``known``: index of an earlier set of the same class.
        """
        me = len(self.sizes)
        self.sizes.append(len(tokens))
        self.parent.append(me if known is None else self.find(known))
        found = self._search(me, tokens)
        self._insert(me, tokens)
        return found

    def _search(self, me: int, tokens: list[int]) -> list[int]:
        have, size, percent = set(tokens), len(tokens), self.percent
        found = []
        # Node, overlap along the path, tokens along the path.
        stack = [(child, 0, 0) for child in self.root.children.values()]
        while stack:
            node, overlap, depth = stack.pop()
            if 100 * node.most < percent * size or percent * node.least > 100 * size:
                continue
            if not node.children and self.find(node.owner) == self.find(me):
                continue
            needed = self._needed(size, max(node.least, -(-percent * size // 100)))
            alive = True
            for step, last in node.steps:
                overlap += len(have & step)
                depth += len(step)
                # What is left on either side bounds the overlap.
                if overlap + min(size - bisect_right(tokens, last), node.most - depth) < needed:
                    alive = False
                    break
            if not alive:
                continue
            owner = node.owner
            if owner is not None and 100 * overlap >= percent * (size + self.sizes[owner] - overlap):
                mine, other = self.find(me), self.find(owner)
                if mine != other:
                    self.parent[mine] = other
                    found.append(owner)
            stack += [(child, overlap, depth) for child in node.children.values()]
        return found

    def _insert(self, me: int, tokens: list[int]) -> None:
        node, at, size = self.root, 0, len(tokens)
        while True:
            node.least, node.most = min(node.least, size), max(node.most, size)
            if at == size:
                if node.owner is None:
                    node.owner = me
                return  # an equal set: its class is that of the owner, which it was linked with
            child = node.children.get(tokens[at])
            if child is None:
                node.children[tokens[at]] = _Node(tokens[at:], me, size)
                return
            edge = child.tokens
            same = 0
            while same < len(edge) and at + same < size and edge[same] == tokens[at + same]:
                same += 1
            if same < len(edge):
                upper = _Node(edge[:same], None, child.most)
                upper.least = child.least
                child.edge(edge[same:])
                upper.children[child.tokens[0]] = child
                node.children[edge[0]] = upper
                child = upper
            node, at = child, at + same
