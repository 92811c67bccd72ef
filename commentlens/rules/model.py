"""One rule shape for every kind of text test.

``groups`` is in conjunctive form: a rule fires when every group has at least one pattern that
matches. Rules are tried in list order and the first that fires names the source.

``needs`` speeds up slow patterns: every text a regular expression matches holds, apart from case,
at least one of these literals, so texts with none of them are settled by a plain search.
"""

from __future__ import annotations

from dataclasses import dataclass

MODES = ("contains", "prefix", "regex_search", "regex_anchored")
TARGETS = ("text", "last_sentence")


@dataclass(frozen=True)
class Rule:
    label: str
    groups: tuple[tuple[str, ...], ...]
    mode: str = "contains"
    ignore_case: bool = False
    target: str = "text"
    needs: tuple[str, ...] = ()

    def __post_init__(self):
        if self.mode not in MODES or self.target not in TARGETS:
            raise ValueError(f"unknown mode or target in rule {self.label}")
        if not self.groups or not all(self.groups):
            raise ValueError(f"rule {self.label} has an empty group")


def any_of(label: str, *phrases: str, **kw) -> Rule:
    return Rule(label, (phrases,), **kw)


def all_of(label: str, *phrases: str, **kw) -> Rule:
    return Rule(label, tuple((p,) for p in phrases), **kw)


def prefix(label: str, *phrases: str) -> Rule:
    return Rule(label, (phrases,), mode="prefix")


def shadowed(rules: list[Rule]) -> list[tuple[int, int]]:
    """Pairs (later, earlier) where a plain earlier rule always fires before the later one can.

    Only substring rules are compared: the later rule is dead when each of its own one-group
    patterns contains a pattern of a single-group earlier rule of the same case handling.
    """
    found = []
    for i, late in enumerate(rules):
        if late.mode not in ("contains", "prefix") or late.target != "text":
            continue
        for j, early in enumerate(rules[:i]):
            if early.mode != "contains" or early.target != "text" or len(early.groups) != 1:
                continue
            if early.ignore_case != late.ignore_case and not early.ignore_case:
                continue
            fold = str.lower if early.ignore_case else str
            if any(
                all(any(fold(e) in fold(p) for e in early.groups[0]) for p in group)
                for group in late.groups
            ):
                found.append((i, j))
                break
    return found
