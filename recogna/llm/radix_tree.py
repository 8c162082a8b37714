"""An adaptive radix tree over byte strings: nodes of 4, 16, 48 or 256 children, common bytes kept as a path."""

from __future__ import annotations

from bisect import bisect_left
from typing import Any


class Sorted:
    """4 or 16 children: key bytes in order beside their children."""

    __slots__ = ("bytes", "children", "most")

    def __init__(self, most: int = 4) -> None:
        self.most, self.bytes, self.children = most, bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = bisect_left(self.bytes, byte)
        return self.children[at] if at < len(self.bytes) and self.bytes[at] == byte else None

    def put(self, byte: int, child: Node) -> Layout:
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.children[at] = child
            return self
        if len(self.children) == self.most:
            return (Sorted(16) if self.most == 4 else Indexed()).filled(self).put(byte, child)
        self.bytes.insert(at, byte)
        self.children.insert(at, child)
        return self

    def filled(self, other: Sorted) -> Sorted:
        self.bytes, self.children = other.bytes, other.children
        return self

    def ordered(self) -> list[Node]:
        return self.children


class Indexed:
    """48 children: 256 places that say which child a byte has."""

    __slots__ = ("index", "children")

    def __init__(self) -> None:
        self.index, self.children = bytearray(256), []  # place 0: no child, n: child n - 1

    def get(self, byte: int) -> Node | None:
        at = self.index[byte]
        return self.children[at - 1] if at else None

    def put(self, byte: int, child: Node) -> Layout:
        at = self.index[byte]
        if at:
            self.children[at - 1] = child
            return self
        if len(self.children) == 48:
            return Direct().filled(self).put(byte, child)
        self.children.append(child)
        self.index[byte] = len(self.children)
        return self

    def filled(self, other: Sorted) -> Indexed:
        for byte, child in zip(other.bytes, other.children, strict=True):
            self.put(byte, child)
        return self

    def ordered(self) -> list[Node]:
        return [self.children[at - 1] for at in self.index if at]


class Direct:
    """256 children, each at its byte."""

    __slots__ = ("children",)

    def __init__(self) -> None:
        self.children: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.children[byte]

    def put(self, byte: int, child: Node) -> Layout:
        self.children[byte] = child
        return self

    def filled(self, other: Indexed) -> Direct:
        for byte, at in enumerate(other.index):
            if at:
                self.children[byte] = other.children[at - 1]
        return self

    def ordered(self) -> list[Node]:
        return [c for c in self.children if c is not None]


Layout = Sorted | Indexed | Direct


class Node:
    """``path`` are the bytes from the parent's end on; a value stands where a key ends, also above other keys."""

    __slots__ = ("path", "value", "layout")

    def __init__(self, path: bytes, value: Any = None) -> None:
        self.path, self.value, self.layout = path, value, None

    def put(self, byte: int, child: Node) -> None:
        self.layout = (self.layout or Sorted()).put(byte, child)

    def ordered(self) -> list[Node]:
        return self.layout.ordered() if self.layout else []


def _common(a: bytes, b: bytes, begin: int) -> int:
    """How many first bytes ``a`` and ``b`` from ``begin`` on share."""
    most = min(len(a), len(b) - begin)
    if a[:most] == b[begin : begin + most]:
        return most
    low, high = 0, most  # the first difference, by halving
    while high - low > 1:
        middle = (low + high) // 2
        if a[:middle] == b[begin : begin + middle]:
            low = middle
        else:
            high = middle
    return low


class RadixTree:
    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, key: bytes, value: Any) -> None:
        """Put a value that isn't None at ``key``, in place of one that is there."""
        node, at = self.root, 0
        while True:
            if at == len(key):
                node.value = value
                return
            child = node.layout.get(key[at]) if node.layout else None
            if child is None:
                node.put(key[at], Node(key[at:], value))
                return
            same = _common(child.path, key, at)
            if same < len(child.path):  # the path forks, or the key ends within it
                upper = Node(child.path[:same])
                child.path = child.path[same:]
                upper.put(child.path[0], child)
                node.put(key[at], upper)
                child = upper
            node, at = child, at + same
