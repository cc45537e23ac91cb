"""Probabilistic automata learned from example strings by merging prefix-tree states."""

from __future__ import annotations

import math

# Confidence of the compatibility test, and weight of the uniform symbol distribution.
ALPHA, SMOOTHING = 0.05, 1.0
END = ""


class State:
    __slots__ = ("total", "counts", "next")

    def __init__(self):
        self.total, self.counts, self.next = 0, {}, {}


class Automaton:
    """Deterministic, with a count for each transition and for each ending.

    The prefix tree of the examples is folded from the root on. A state outside the kept
    ones merges with the kept state that gives its strings the highest likelihood, among
    those whose symbol frequencies agree with its own, and recursively those of their
    successors, within Hoeffding's bound. A state that agrees with none is kept.
    """

    def __init__(self, examples: list[str], alphabet: int):
        self.choices = alphabet + 1
        self.root = State()
        for text in examples:
            at = self.root
            for symbol in (*text, END):
                at.total += 1
                at.counts[symbol] = at.counts.get(symbol, 0) + 1
                if symbol != END:
                    at = at.next.setdefault(symbol, State())
        self._fold()

    def _cost(self, state: State | None, symbol: str) -> float:
        """Bits of a symbol in a state, smoothed; a state never seen is uniform."""
        if state is None:
            return math.log2(self.choices)
        seen = state.counts.get(symbol, 0) + SMOOTHING / self.choices
        return -math.log2(seen / (state.total + SMOOTHING))

    def bits(self, text: str) -> float:
        state, total = self.root, 0.0
        for symbol in (*text, END):
            total += self._cost(state, symbol)
            state = state.next.get(symbol) if state else None
        return total

    @staticmethod
    def _agree(a: State, b: State) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            if not a.total or not b.total:
                continue
            bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(a.total) + 1 / math.sqrt(b.total))
            for symbol in a.counts.keys() | b.counts.keys():
                if abs(a.counts.get(symbol, 0) / a.total - b.counts.get(symbol, 0) / b.total) > bound:
                    return False
                if symbol in a.next and symbol in b.next:
                    stack.append((a.next[symbol], b.next[symbol]))
        return True

    def _tree_bits(self, kept: State, tree: State) -> float:
        """Bits of all strings below a tree state, read from a kept state."""
        total, stack = 0.0, [(kept, tree)]
        while stack:
            at, node = stack.pop()
            for symbol, n in node.counts.items():
                total += n * self._cost(at, symbol)
                if symbol in node.next:
                    stack.append((at.next.get(symbol) if at else None, node.next[symbol]))
        return total

    @staticmethod
    def _absorb(kept: State, tree: State) -> None:
        stack = [(kept, tree)]
        while stack:
            a, b = stack.pop()
            a.total += b.total
            for symbol, n in b.counts.items():
                a.counts[symbol] = a.counts.get(symbol, 0) + n
            for symbol, node in b.next.items():
                if symbol in a.next:
                    stack.append((a.next[symbol], node))
                else:
                    a.next[symbol] = node

    def _fold(self) -> None:
        kept = [self.root]
        while True:
            known = {id(s) for s in kept}
            border = [(s.next[c].total, len(kept) - i, c, s) for i, s in enumerate(kept) for c in s.next if id(s.next[c]) not in known]
            if not border:
                self.states = kept
                return
            _, _, symbol, parent = max(border, key=lambda x: x[:3])
            node = parent.next[symbol]
            fits = [s for s in kept if self._agree(s, node)]
            if fits:
                best = min(fits, key=lambda s: self._tree_bits(s, node))
                parent.next[symbol] = best
                self._absorb(best, node)
            else:
                kept.append(node)
