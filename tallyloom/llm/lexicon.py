"""Words near a lexicon: the Levenshtein automaton of a word run over the trie of the lexicon.

A state is a set of (trie node, edits so far); reading a character follows the trie, or spends an edit on a
substitution, an extra or a left-out character. States are made when first met and kept, so a text's words cost one
table look-up for each character.
"""

from __future__ import annotations


class Matcher:
    """Finds the entry that a word equals, starts with, or misses by few edits.

    `entries` maps a term to (edits allowed, whether it is a stem). A stem also accepts every word that begins with it.
    """

    def __init__(self, entries: dict[str, tuple[int, bool]], remembered: int = 50_000):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        self.entries, self.remembered = entries, remembered
        #: The edits that any term below a node allows.
        self.allowed = [0]
        for term, (edits, _) in sorted(entries.items()):
            node = 0
            self.allowed[0] = max(self.allowed[0], edits)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.allowed.append(0)
                node = self.children[node][c]
                self.allowed[node] = max(self.allowed[node], edits)
            self.ends[node] = term
        self._forget()

    def _forget(self) -> None:
        self.steps: dict[tuple[int, str], int] = {}
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.start = self._number(self._closed({0: 0}, {}))

    def _closed(self, nodes: dict[int, int], stems: dict[str, int]) -> frozenset:
        """With the trie characters that the word may leave out; stems that are complete stay so."""
        todo = list(nodes.items())
        while todo:
            node, edits = todo.pop()
            if nodes.get(node, 99) < edits:
                continue
            for child in self.children[node].values():
                if edits < self.allowed[child] and nodes.get(child, 99) > edits + 1:
                    nodes[child] = edits + 1
                    todo.append((child, edits + 1))
        for node, edits in nodes.items():
            term = self.ends[node]
            if term is not None and self.entries[term][1] and edits <= self.entries[term][0]:
                stems[term] = min(edits, stems.get(term, 99))
        return frozenset([*nodes.items(), *((t, e) for t, e in stems.items())])

    def _number(self, state: frozenset) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        return self.numbers[state]

    def _step(self, number: int, c: str) -> int:
        nodes: dict[int, int] = {}
        stems: dict[str, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.allowed[node] and nodes.get(node, 99) > edits:
                nodes[node] = edits

        for place, edits in self.states[number]:
            if isinstance(place, str):
                stems[place] = min(edits, stems.get(place, 99))
                continue
            reach(place, edits + 1)
            for letter, child in self.children[place].items():
                reach(child, edits if letter == c else edits + 1)
        return self._number(self._closed(nodes, stems))

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) with the fewest edits, then the longest and first term; None if no term accepts the word."""
        if len(self.steps) > self.remembered:
            self._forget()
        state = self.start
        for c in word:
            nxt = self.steps.get((state, c))
            if nxt is None:
                nxt = self.steps[state, c] = self._step(state, c)
            if not self.states[nxt]:
                return None
            state = nxt
        found = []
        for place, edits in self.states[state]:
            term = place if isinstance(place, str) else self.ends[place]
            if term is not None and edits <= self.entries[term][0]:
                found.append((edits, -len(term), term))
        if not found:
            return None
        edits, _, term = min(found)
        return term, edits
