"""Deep-shallow sorting of byte strings that share a beginning, or tend to.

Multikey quicksort orders the strings by ``CHUNK`` bytes at a time down to ``SHALLOW`` bytes. Groups that
are still equal there have long common prefixes, which comparing anew would read again and again: a blind
trie orders them. It branches only where strings differ and stores one byte per branch; a string is inserted
by following these bytes to some leaf, comparing with that leaf's string once, and branching where the two
part.
"""

from collections.abc import Sequence

CHUNK, SHALLOW = 8, 32


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class _Node:
    """Leaves have a list of equal strings' numbers, branches a depth and children by byte (-1: end)."""

    __slots__ = ("depth", "children", "items")

    def __init__(self, depth: int, children: dict, items: list[int]):
        self.depth, self.children, self.items = depth, children, items


def _byte(s: bytes, at: int) -> int:
    return s[at] if at < len(s) else -1


class BlindTrie:
    def __init__(self, strings: Sequence[bytes]):
        self.strings = strings
        self.root: _Node | None = None

    def insert(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = _Node(len(s), {}, [i])
            return
        # Blindly to some leaf: where a byte is unknown, any child will do.
        node, path = self.root, []
        while node.children:
            path.append(node)
            node = node.children.get(_byte(s, node.depth)) or next(iter(node.children.values()))
        other = self.strings[node.items[0]]
        shared = common(s, other)
        if shared == len(s) == len(other):
            node.items.append(i)
            return
        # The first node of the path at or below the depth where the strings part.
        parent = None
        node = self.root
        while node.children and node.depth < shared:
            parent = node
            node = node.children[_byte(other, node.depth)]
        leaf = _Node(len(s), {}, [i])
        if node.children and node.depth == shared:
            node.children[_byte(s, shared)] = leaf
            return
        branch = _Node(shared, {_byte(other, shared): node, _byte(s, shared): leaf}, [])
        if parent is None:
            self.root = branch
        else:
            parent.children[_byte(other, parent.depth)] = branch

    def order(self) -> tuple[list[int], list[int]]:
        """The strings in order, and the common prefix of each with the one before it."""
        out, lcp = [], []
        todo = [(self.root, 0)] if self.root else []
        while todo:
            node, shared = todo.pop()
            if node.children:
                keys = sorted(node.children, reverse=True)
                todo += [(node.children[key], node.depth) for key in keys[:-1]]
                todo.append((node.children[keys[-1]], shared))
            else:
                out += node.items
                lcp.append(shared)
                lcp += [node.depth] * (len(node.items) - 1)
        return out, lcp


def deep_shallow(
    strings: Sequence[bytes], chunk: int = CHUNK, shallow: int = SHALLOW
) -> tuple[list[int], list[int]]:
    """The order of the strings (a string's end comes before any byte) and the length of the common
    prefix of each with the one before it, 0 for the first."""
    out: list[int] = []
    lcp: list[int] = []
    todo = [(list(range(len(strings))), 0)] if strings else []
    while todo:
        own, depth = todo.pop()
        if len(own) == 1:
            piece = own
            within = [0]
        elif depth >= shallow:
            trie = BlindTrie(strings)
            for i in own:
                trie.insert(i)
            piece, within = trie.order()
        else:
            pivot = strings[own[len(own) // 2]][depth : depth + chunk]
            less, equal, more = [], [], []
            for i in own:
                part = strings[i][depth : depth + chunk]
                (less if part < pivot else more if part > pivot else equal).append(i)
            if more:
                todo.append((more, depth))
            # A pivot shorter than a chunk is the end of all these strings: they are equal.
            todo.append((equal, depth + chunk if len(pivot) == chunk else max(depth, shallow)))
            if less:
                todo.append((less, depth))
            continue
        if out:
            within[0] = common(strings[out[-1]], strings[piece[0]])
        out += piece
        lcp += within
    return out, lcp
