"""Sectors and places (K-03...K-08): fixed tables, read in a fixed order, over one pass of a text's words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import phrases as P
from tidemark.functions.match import bind, every_phrase, first_label, holds, phrases_in, starts_with_any
from tidemark.functions.text import searchable


def _named(name: Column, table: tuple[tuple[str, tuple[str, ...]], ...]) -> Column:
    """The sector one of whose names is all of a searchable name."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for sector, names in table:
        out = out.when(name.isin(*names), sector)
    return out


def source_sector(given: Column) -> Column:
    """K-04: a sector as a source gives it: one of the sectors itself or a known name of one, else unknown."""
    cleaned = F.trim(F.coalesce(given, F.lit("")))
    exact = F.when(cleaned.isin(*P.SECTORS), cleaned)
    return F.coalesce(exact, _named(searchable(cleaned), P.ACTIVITY_NAMES + P.STRUCTURED_NAMES), F.lit(P.UNKNOWN))


def _health_body(blob: Column, hits: Column) -> Column:
    """Whether a body and a mission in health meet, or the name of the health agency begins the text."""
    return blob.startswith("sante publique ") | (holds(hits, P.HEALTH_BODIES) & holds(hits, P.HEALTH_MISSIONS))


def activity_sector(text: Column) -> Column:
    """K-06: the sector of a described activity: health institutions first, then the first sector with a phrase in it."""
    wanted = (*every_phrase(P.ACTIVITY_RULES), *P.HEALTH_BODIES, *P.HEALTH_MISSIONS)

    def judged(blob: Column) -> Column:
        return bind(
            phrases_in(blob, wanted), lambda hits: F.when(_health_body(blob, hits), P.HEALTH).otherwise(first_label(hits, P.ACTIVITY_RULES, P.UNKNOWN))
        )

    return bind(searchable(text), judged)


def name_sector(name: Column, watched: Column | None = None) -> Column:
    """K-05: the sector that a name alone proves. `watched` is the sector of a watched entity of this name, if any.

    Then institutions by how their name begins or ends, then phrases; sport needs a federation with a discipline.
    """
    wanted = (*every_phrase(P.NAME_RULES), *P.HEALTH_BODIES, *P.HEALTH_MISSIONS, *P.SPORT_TERMS)

    def judged(blob: Column) -> Column:
        def by(hits: Column) -> Column:
            health = _health_body(blob, hits) | starts_with_any(blob, P.HEALTH_OPENINGS)
            admin = (blob == "service public") | starts_with_any(blob, P.ADMIN_OPENINGS) | blob.endswith(" metropole")
            taught = starts_with_any(blob, P.EDUCATION_OPENINGS) | blob.endswith(" school of business") | blob.endswith(" business school")
            federation = starts_with_any(blob, P.SPORT_FEDERATIONS) & holds(hits, P.SPORT_TERMS)
            sport = blob.contains("stade francais") | blob.startswith("federation sportive ") | federation
            out = F.when(health, P.HEALTH).when(admin, P.ADMIN).when(taught, P.EDUCATION).when(blob.startswith("mutuelle "), P.FINANCE)
            return out.when(sport, P.SPORT).otherwise(first_label(hits, P.NAME_RULES, P.UNKNOWN))

        return bind(phrases_in(blob, wanted), by)

    known = F.nullif(F.coalesce(watched, F.lit("")), F.lit("")) if watched is not None else F.lit(None).cast("string")
    return F.coalesce(F.nullif(known, F.lit(P.UNKNOWN)), bind(searchable(name), judged))


def rule_sector(text: Column) -> Column:
    """The first sector with a phrase of an activity in a text; null without one."""
    return bind(phrases_in(searchable(text), every_phrase(P.ACTIVITY_RULES)), lambda hits: first_label(hits, P.ACTIVITY_RULES))


def sector(texts: list[Column], given: Column | None = None) -> Column:
    """K-03: the sector a source gives (a sector, a known name, or a phrase), then the first of `texts` that tells one."""
    steps = [rule_sector(t) for t in texts]
    if given is not None:
        cleaned = F.trim(F.coalesce(given, F.lit("")))
        exact = F.when(cleaned.isin(*P.SECTORS, P.UNKNOWN), cleaned)
        steps = [exact, _named(searchable(cleaned), P.ACTIVITY_NAMES), rule_sector(cleaned), *steps]
    return F.coalesce(*steps, F.lit(P.UNKNOWN))


def _place_in(raw: Column) -> Column:
    """K-08: the place a text tells, null without one: the island's own name, a postal code or department, a phrase."""

    def judged(blob: Column) -> Column:
        # a look for what must stand in any match is cheaper than a pattern
        out = F.when((raw.contains("union") | raw.contains("UNION")) & raw.rlike(P.REUNION_NAME), P.REUNION)
        for place, number in P.DEPARTMENTS:
            out = out.when(blob.contains(number) & blob.rlike(rf"\b{number}\d{{2}}\b|\bdepartement\s+(?:de\s+)?{number}\b"), place)
        hints = bind(phrases_in(blob, every_phrase(P.PLACE_HINTS)), lambda hits: first_label(hits, P.PLACE_HINTS))
        return out.otherwise(hints)

    return bind(searchable(raw), judged)


def location(texts: list[Column], *, given: Column | None = None, entity: Column | None = None, default: Column | None = None) -> Column:
    """K-07: what the source gives, then the place of a watched entity, then what the texts tell, then the default.

    Given, entity and default count only if they name a place (given may also tell one, as a text does).
    """
    steps = []
    if given is not None:
        cleaned = F.trim(F.coalesce(given, F.lit("")))
        steps += [F.when(cleaned.isin(*P.PLACES, P.UNKNOWN), cleaned), _place_in(cleaned)]
    if entity is not None:
        steps.append(F.when(entity.isin(*P.PLACES, P.UNKNOWN), entity))
    present = F.filter(F.array(*texts), lambda t: t.isNotNull() & (t != ""))
    steps.append(_place_in(F.array_join(present, " ")))
    if default is not None:
        steps.append(F.when(default.isin(*P.PLACES), default))
    return F.coalesce(*steps, F.lit(P.UNKNOWN))
