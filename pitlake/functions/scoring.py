"""Similarity of names as 0 to 100: token sets compared by longest common subsequence."""

from __future__ import annotations


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by the bit-parallel recurrence of Hyyro."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    row = (1 << len(a)) - 1
    full = row
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """100 for equal strings, 0 for nothing in common: 1 - insertions and deletions over both lengths."""
    total = len(a) + len(b)
    return 100.0 if not total else 200.0 * lcs_length(a, b) / total


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio of the shared tokens, and these with either rest; 100 if one set holds the other."""
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    left, right = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 100.0
    with_left, with_right = f"{both} {left}".strip(), f"{both} {right}".strip()
    best = ratio(with_left, with_right)
    return max(best, ratio(both, with_left), ratio(both, with_right)) if both else best
