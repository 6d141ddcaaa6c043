"""Ordered first-match rules over a text column.

A rule set is data: a list of `Rule` rows. `label_by_rules` turns it into one CASE
expression in which every rule is a single regular expression (or a few substring
tests), so labelling is a narrow projection without any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold.functions.text import WORD, contains_any


@dataclass(frozen=True)
class Rule:
    """One row of a rule table. All wording is `|`-separated and lower case.

    words: phrases with word edges on both sides
    stems: phrases with a word edge on the left only
    inner: phrases that must directly follow a word character
    outer: phrases that must directly precede a word character
    """

    label: str
    reason: str = ""
    words: str = ""
    stems: str = ""
    inner: str = ""
    outer: str = ""

    def pattern(self) -> str:
        """The rule as one alternation."""
        left, right = rf"(?<!{WORD})", rf"(?!{WORD})"
        forms = []
        if self.words:
            forms.append(rf"{left}(?:{self.words}){right}")
        if self.stems:
            forms.append(rf"{left}(?:{self.stems})")
        if self.inner:
            forms.append(rf"(?<={WORD})(?:{self.inner}){right}")
        if self.outer:
            forms.append(rf"{left}(?:{self.outer})(?={WORD})")
        return "|".join(forms)


@dataclass(frozen=True)
class PartRule:
    """Substring rule: any of `parts`, all of `also`, none of `but`."""

    label: str
    parts: tuple[str, ...]
    also: tuple[str, ...] = field(default=())
    but: tuple[str, ...] = field(default=())


def rule_matches(text: Column, rule: Rule | PartRule) -> Column:
    if isinstance(rule, Rule):
        return text.rlike(rule.pattern())
    hit = contains_any(text, rule.parts)
    for part in rule.also:
        hit = hit & text.contains(part)
    for part in rule.but:
        hit = hit & ~text.contains(part)
    return hit


def first_match(
    text: Column,
    rules: Sequence[Rule | PartRule],
    value: Callable[[int, Rule | PartRule], Column],
    otherwise: Column,
) -> Column:
    """CASE over the rules in order, with `value` giving each branch's result."""
    chain = None
    for position, rule in enumerate(rules):
        condition = rule_matches(text, rule)
        result = value(position, rule)
        chain = F.when(condition, result) if chain is None else chain.when(condition, result)
    return otherwise if chain is None else chain.otherwise(otherwise)


def label_by_rules(text: Column, rules: Sequence[Rule | PartRule], default: str) -> Column:
    return first_match(text, rules, lambda _, rule: F.lit(rule.label), F.lit(default))


def rule_number(text: Column, rules: Sequence[Rule | PartRule]) -> Column:
    """Index of the first matching rule, `len(rules)` if none.

    Label and reason are both looked up from this number, so the expressions run once.
    """
    return first_match(text, rules, lambda position, _: F.lit(position), F.lit(len(rules)))


def pick(number: Column, values: Sequence[str]) -> Column:
    """Entry `number`, counted from 0, of a constant list.

    The list travels as one string and Catalyst folds the split into an array literal.
    """
    return F.element_at(F.split(F.lit("\n".join(values)), "\n"), (number + 1).cast("int"))
