"""Small default dimensions. Users pass their own; these are examples and the values of the registered queries."""

from __future__ import annotations

from dataclasses import dataclass, field

ROLES = {"user": "CLIENT", "assistant": "ADMIN", "system": "SYSTEM"}


@dataclass(frozen=True)
class Category:
    """A category with its words and phrases."""

    name: str
    keywords: tuple[str, ...] = ()
    phrases: tuple[str, ...] = ()
    definition: str = ""


@dataclass(frozen=True)
class Taxonomy:
    """Categories in order of priority, with the name used when none fits."""

    categories: tuple[Category, ...] = field(default_factory=tuple)
    fallback: str = "OTHER"
    version: int = 1

    def names(self) -> list[str]:
        """Category names in order, the fallback last."""
        return [*(c.name for c in self.categories), self.fallback]


#: Words that occur in the test tables' prose.
TAXONOMY = Taxonomy((
    Category("PLACE", ("from", "dans", "von"), ("at the",), "Says where something is or comes from."),
    Category("MEANS", ("with", "avec", "mit"), ("by the",), "Says by what means something is done."),
    Category("REASON", ("for", "pour", "por"), (), "Says what something is for."),
))
REMOTE_WORDS = ("from", "dans", "auf")
CREDENTIAL_WORDS = ("that", "que", "das")
CLOSING_WORDS = ("was", "sur", "ist")
WAITING_WORDS = ("there", "pas", "nicht")
SLANG = {"thth": "that", "ofof": "of", "andand": "and", "thehe": "the", "onon": "on"}
GENERAL_WORDS = {"ing": "going", "tion": "action", "ent": "entity"}
PROTECTED = ("the", "und", "les")
STOP_WORDS = ("the", "of", "and", "a", "to", "in", "is", "that", "it", "was", "for", "on", "are", "with", "as", "be", "at", "by", "this", "from", "or")
