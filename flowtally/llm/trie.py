"""Compressed radix tree over byte strings, with subtrees that go to disk under pressure."""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from typing import Any

NODE_BYTES = 300
Merge = Callable[[Any, Any], Any]


def common_length(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Node:
    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes, value: Any = None):
        self.label, self.children, self.value = label, None, value


class Spilled:
    """A child whose subtree lies in a scratch file; later keys are gathered and appended."""

    __slots__ = ("path", "waiting")

    def __init__(self, path: str):
        self.path, self.waiting = path, []


class PatriciaTrie:
    """Byte strings -> a merged value at each terminal node.

    `add` merges values of equal keys. Beyond `budget` bytes the tree goes down its heaviest
    path to the last node that holds half of the budget, however long the prefix is that all
    keys share, and the subtrees of that node's children go to scratch files of the task.
    Later keys that pass through such a child are gathered and appended to its file. `items`
    reads each file into a tree of its own, under the same budget, whose root stands behind
    the prefix that all its keys share; so each level divides the keys further. Scratch files
    go as soon as they are read, or with `close`.
    """

    def __init__(self, merge: Merge, budget: int = 64 << 20, prefix: bytes = b""):
        self.merge, self.budget, self.prefix = merge, budget, prefix
        self.root = Node(b"")
        self.spilled: set[Spilled] = set()
        self.size = self.gathered = 0
        self.limit = budget

    def add(self, key: bytes, value: Any) -> None:
        self.size += self._insert(key, value)
        if self.gathered > self.budget // 4:
            self._append()
        if self.size > self.limit:
            self._spill()
            # where labels alone fill the budget, it is not tried again for every key
            self.limit = max(self.budget, self.size + self.budget // 4)

    def _insert(self, key: bytes, value: Any) -> int:
        """Bytes by which the tree grew."""
        node, at, grown = self.root, len(self.prefix), 0
        while True:
            label = node.label
            if not key.startswith(label, at):
                shared = common_length(label, key[at : at + len(label)])
                lower = Node(label[shared:], node.value)
                lower.children = node.children
                node.label, node.value, node.children = label[:shared], None, {label[shared]: lower}
                label, grown = node.label, NODE_BYTES
            at += len(label)
            if at == len(key):
                if node.value is None:
                    node.value = value
                    return grown + 1
                node.value = self.merge(node.value, value)
                return grown
            if node.children is None:
                node.children = {}
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], value)
                return grown + NODE_BYTES + len(key) - at
            if isinstance(child, Spilled):
                child.waiting.append((key, value))
                self.gathered += NODE_BYTES + len(key)
                return grown
            node = child

    def _append(self) -> None:
        for child in self.spilled:
            if child.waiting:
                with open(child.path, "ab") as file:
                    for entry in child.waiting:
                        pickle.dump(entry, file, pickle.HIGHEST_PROTOCOL)
                child.waiting = []
        self.gathered = 0

    def _sizes(self) -> dict[int, int]:
        """Bytes of the subtree at each node in memory."""
        order = [self.root]
        for node in order:
            order.extend(c for c in (node.children or {}).values() if isinstance(c, Node))
        sizes: dict[int, int] = {}
        for node in reversed(order):
            below = sum(sizes[id(c)] for c in (node.children or {}).values() if isinstance(c, Node))
            sizes[id(node)] = below + NODE_BYTES + len(node.label)
        return sizes

    def _spill(self) -> None:
        sizes, node, before = self._sizes(), self.root, self.prefix
        while True:
            inner = [c for c in (node.children or {}).values() if isinstance(c, Node)]
            heavy = max(inner, key=lambda c: sizes[id(c)], default=None)
            if heavy is None or not heavy.children or sizes[id(heavy)] < self.budget // 2:
                break
            if not any(isinstance(c, Node) for c in heavy.children.values()):
                break
            node, before = heavy, before + heavy.label
        for first, child in list((node.children or {}).items()):
            if isinstance(child, Node):
                handle, path = tempfile.mkstemp(prefix="subtree-")
                node.children[first] = Spilled(path)
                self.spilled.add(node.children[first])
                self._write(handle, child, before)
                self.size -= sizes[id(child)]

    def _write(self, handle: int, top: Node, before: bytes) -> None:
        """Terminal nodes of a subtree; a child that is on disk already hands its file over."""
        with os.fdopen(handle, "wb") as file:
            for key, value in _walk(top, self._take_over(file)):
                pickle.dump((before + key, value), file, pickle.HIGHEST_PROTOCOL)

    def _take_over(self, file) -> Callable[[Spilled], None]:
        def take(inner: Spilled) -> None:
            for entry in chain(_read(inner.path), inner.waiting):
                pickle.dump(entry, file, pickle.HIGHEST_PROTOCOL)
            self.spilled.discard(inner)
            os.unlink(inner.path)

        return take

    def items(self) -> Iterator[tuple[bytes, Any]]:
        """Each key and its merged value, once; empties the tree."""
        try:
            self._append()
            for key, value in _walk(self.root, lambda inner: None):
                yield self.prefix + key, value
            self.root, self.size, self.limit = Node(b""), 0, self.budget
            while self.spilled:
                child = self.spilled.pop()
                try:
                    prefix = None
                    for key, _value in _read(child.path):
                        prefix = key if prefix is None else prefix[: common_length(prefix, key)]
                    below = PatriciaTrie(self.merge, self.budget, prefix or b"")
                    try:
                        for key, value in _read(child.path):
                            below.add(key, value)
                    except BaseException:
                        below.close()
                        raise
                finally:
                    os.unlink(child.path)
                yield from below.items()
        finally:
            self.close()

    def close(self) -> None:
        """Removes the scratch files that are left."""
        while self.spilled:
            os.unlink(self.spilled.pop().path)


def _walk(top: Node, on_disk: Callable[[Spilled], None]) -> Iterator[tuple[bytes, Any]]:
    """(key below the tree's root, value) of every terminal node, without recursion."""
    stack = [(top, b"")]
    while stack:
        node, before = stack.pop()
        if isinstance(node, Spilled):
            on_disk(node)
            continue
        key = before + node.label
        if node.value is not None:
            yield key, node.value
        if node.children:
            stack.extend((child, key) for child in node.children.values())


def _read(path: str) -> Iterable[tuple[bytes, Any]]:
    with open(path, "rb") as file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return
