"""Forms of a word under one-letter prefixes and suffixes, in six tiers; as plain strings, for dictionaries, and as column expressions in ``text``."""

from __future__ import annotations

from typing import NamedTuple

TIERS = {1: "word", 2: "prefix off", 3: "suffix off", 4: "both off", 5: "prefix on", 6: "prefix changed"}


class Affixes(NamedTuple):
    """Prefix letters, suffixes, and how much of a word must remain."""

    prefixes: str
    suffixes: tuple[str, ...]
    rounds: int = 2
    longer_than: int = 3  # a prefix comes off longer words only
    least: int = 3  # characters that remain when a suffix comes off

    def without_prefix(self, word: str) -> str:
        """Up to ``rounds`` prefix letters taken off, while the word is longer than ``longer_than``."""
        for _ in range(self.rounds):
            if len(word) > self.longer_than and word[0] in self.prefixes:
                word = word[1:]
        return word

    def without_suffix(self, word: str) -> str:
        """The longest suffix that fits taken off, if enough remains."""
        for s in sorted(self.suffixes, key=lambda s: (-len(s), s)):
            if word.endswith(s) and len(word) - len(s) >= self.least:
                return word[: -len(s)]
        return word

    def forms(self, word: str) -> list[tuple[int, str]]:
        """(tier, form) of a word in the order they are tried, each form once.

        A text that holds a form of tier 5 or 6 holds that of tier 1 or 2 as well,
        so by plain containment these two never decide; they do where a form must
        stand as a word.
        """
        bare, cut = self.without_prefix(word), self.without_suffix(word)
        stem = self.without_suffix(bare)
        every = [(1, word), (2, bare), (3, cut), (4, stem), *((5, p + word) for p in self.prefixes), *((6, p + bare) for p in self.prefixes if bare != word)]
        seen: dict[str, int] = {}
        for tier, form in every:
            if form:
                seen.setdefault(form, tier)
        return [(t, f) for f, t in seen.items()]
