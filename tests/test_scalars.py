"""Scalars against literal values."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tests.test_taxonomy import values
from tidemark.functions import text as X
from tidemark.functions import values as V

KEYS = {
    "Ville_de Lyon Москва": "ville_de lyon москва", "Mairie piratée": "mairie", "ACME SAS revendiqué piratée": "acme", "A1b 2": "a1b2", "Booking.com": "booking",
    "Crédit  Agricole, SA": "credit agricole", "piratés": "", "Ｃafé": "cafe", None: "", "Sa Majesté 4": "majeste4",
}
ACRONYMS = {"Centre pour l'Enfance en Bretagne SAS": "CEB", "Régie des Transports et de l'Eau": "RTE", "Institut of the Sea": "IOTS", "": "", None: ""}
CUTS = {
    "Mairie de Lille — Piratée hier": "Mairie de Lille", "Piratée": "Piratée", "Rien": "Rien", "Acme, victime d'une attaque": "Acme", None: None,
}
DATES = {
    "12 sept 2025": "2025-09-12", "5 jui 2025": None, "1er mai 2025": None, "1 mai 2025": "2025-05-01", "le 3 février 2024 à 9h": "2024-02-03", "5/1/2025": None,
    "05/01/2025": "2025-01-05", "05.01.2025": "2025-01-05", "2025-02-30": None, "2025-01-05T10:00:00Z": "2025-01-05", "Mon, 06 Jan 2025 10:00:00 +0000": "2025-01-06",
    "31 December 2024": "2024-12-31", "31 juin 2024": None, "": None, None: None,
}


@pytest.mark.parametrize(
    "rule, cases",
    [(X.base_key, KEYS), (X.acronym, ACRONYMS), (lambda c: X.cut_at(c, ["piratee", "victime d"]), CUTS), (lambda c: V.parse_date(c).cast("string"), DATES)],
)
def test_literals(spark, rule, cases):
    assert dict(zip(cases, values(spark, list(cases), rule(F.col("t"))), strict=True)) == cases


def test_ids_keep_the_place_of_what_is_missing(spark):
    got = values(spark, [(None, "7")], F.struct(V.item_id(F.col("t"), F.col("u"), F.col("t"), F.col("t"), F.col("t")).alias("a"), V.incident_id(F.col("t"), F.col("u")).alias("b")), "t string, u string")
    assert got[0].a == "ITM-" + hashlib.sha256(b"|SOURCE_ITEM|7").hexdigest()[:16]
    assert got[0].b == "INC-" + hashlib.sha256(b"|7").hexdigest()[:12].upper()


def test_freshness_without_a_day_is_nothing(spark):
    assert values(spark, [(2,), (7,), (30,), (31,), (None,)], V.freshness_score(F.col("t")), "t int") == [100.0, 80.0, 50.0, 20.0, 0.0]
