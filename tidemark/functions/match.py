"""Many phrases in one pass over a text's words, and a way to name a value that is used often.

A word is looked up once, in a hash set of the phrases' first words; only where it is one are the runs of words that begin
there looked up in the set of phrases. So time does not grow with the number of phrases, and labels are told from the few
phrases found instead of from the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = tuple[tuple[str, tuple[str, ...]], ...]


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def phrases_in(blob: Column, phrases: Iterable[str]) -> Column:
    """array<string>: the phrases that stand in a searchable text (T-02) as whole words, each once, in order of place."""
    wanted = sorted({p.strip() for p in phrases})
    first = sorted({p.split(" ")[0] for p in wanted})
    longer = sorted({p.count(" ") + 1 for p in wanted} - {1})
    none = F.array().cast("array<string>")

    def found(words: Column) -> Column:
        def here(word: Column, i: Column) -> Column:
            runs = F.array(word, *[F.array_join(F.slice(words, i + 1, n), " ") for n in longer])
            return F.when(word.isin(*first), F.filter(runs, lambda r: r.isin(*wanted))).otherwise(none)

        return F.array_distinct(F.flatten(F.transform(words, here)))

    return bind(F.split(F.coalesce(blob, F.lit("")), " "), found)


def holds(hits: Column, phrases: Iterable[str]) -> Column:
    """Whether one of `phrases` is among the phrases found."""
    return F.arrays_overlap(hits, F.array(*[F.lit(p.strip()) for p in phrases]))


def first_label(hits: Column, rules: Rules, unknown: str | None = None) -> Column:
    """The first label, in the order of `rules`, of which a phrase was found; else `unknown`."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for label, phrases in rules:
        out = out.when(holds(hits, phrases), label)
    return out.otherwise(F.lit(unknown).cast("string"))


def every_phrase(rules: Rules) -> tuple[str, ...]:
    return tuple(p for _, phrases in rules for p in phrases)


def starts_with_any(blob: Column, openings: Iterable[str]) -> Column:
    """Whether a text begins with one of `openings`: one anchored look."""
    return blob.rlike("^(?:" + "|".join(openings) + ")")
