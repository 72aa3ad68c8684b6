"""Deep-shallow suffix sorting: multikey quicksort to a shallow depth, then blind tries for what is still equal.

Strings are rows of a matrix of 16-bit characters (a byte plus one; 0 beyond the end). The quicksort compares four
characters at a time. Strings that agree to the shallow depth go into a blind trie, which looks at the characters at its
branches only and makes one full comparison for each string it takes in.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 64  # characters
_PER_WORD = 4


def _words(strings: np.ndarray, depth: int) -> np.ndarray:
    """The first ``depth`` characters, four to a 64-bit number that sorts like them."""
    part = strings[:, :depth]
    if part.shape[1] % _PER_WORD:
        part = np.pad(part, ((0, 0), (0, -part.shape[1] % _PER_WORD)))
    return np.ascontiguousarray(part).astype(">u2").view(">u8").astype(np.uint64)


def _common(a: np.ndarray, b: np.ndarray, at: int) -> int:
    """How many characters two strings share, knowing that they share ``at``."""
    unlike = a[at:] != b[at:]
    first = int(unlike.argmax())
    return at + first if unlike[first] else len(a)


class BlindTrie:
    """Strings that share their first ``depth`` characters, in order."""

    def __init__(self, strings: np.ndarray, depth: int):
        self.strings, self.depth, self.root = strings, depth, None

    def add(self, row: int) -> None:
        # A node is a list: depth of its branch, then children by character; a leaf is a list of depth -1 and equal rows.
        if self.root is None:
            self.root = [-1, [row]]
            return
        text, path, node = self.strings[row], [], self.root
        while node[0] >= 0:
            path.append(node)
            node = node[1].get(int(text[node[0]])) or next(iter(node[1].values()))
        other = node[1][0]
        shared = _common(text, self.strings[other], self.depth)
        if shared == len(text):
            node[1].append(row)
            return
        above, below = None, self.root
        for step in path:
            if step[0] >= shared:
                break
            above, below = step, step[1].get(int(self.strings[other][step[0]]))
        if below[0] == shared:
            below[1][int(text[shared])] = [-1, [row]]
            return
        branch = [shared, {int(self.strings[other][shared]): below, int(text[shared]): [-1, [row]]}]
        if above is None:
            self.root = branch
        else:
            above[1][int(self.strings[other][above[0]])] = branch

    def ordered(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if node[0] < 0:
                out += node[1]
            else:
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]
        return out


def sort_strings(strings: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings, and how many characters each shares with the one before it in that order (-1 for the first)."""
    m, n = strings.shape
    depth = min(shallow, n)
    keys = _words(strings, depth)
    order: list[int] = []
    work = [(np.arange(m), 0)]
    while work:
        rows, at = work.pop()
        if len(rows) == 1:
            order.append(int(rows[0]))
        elif len(rows) == 0:
            pass
        elif at == keys.shape[1] and depth == n:
            order += rows.tolist()  # equal strings
        elif at == keys.shape[1]:
            trie = BlindTrie(strings, depth)
            for row in rows.tolist():
                trie.add(row)
            order += trie.ordered()
        else:
            key = keys[rows, at]
            pivot = key[len(key) // 2]
            work += [(rows[key > pivot], at), (rows[key == pivot], at + 1), (rows[key < pivot], at)]
    sorted_rows = np.array(order, np.int64)
    shared = np.full(m, -1, np.int64)
    if m > 1:
        unlike = strings[sorted_rows[1:]] != strings[sorted_rows[:-1]]
        shared[1:] = np.where(unlike.any(axis=1), unlike.argmax(axis=1), n)
    return sorted_rows, shared
