"""Threats, sectors and places against literal values; the phrase matcher against plain search."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import phrases as P
from tidemark.functions.match import phrases_in
from tidemark.functions.text import searchable, strip_accents
from tidemark.operators import rules as R
from tidemark.operators import taxonomy as X


def values(spark, rows, column, schema="t string"):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


THREATS = {
    "": "Inconnu",
    "Attaque par ransomware contre la mairie": "Ransomware",
    "LockBit revendique l'attaque": "Ransomware",
    "Fuite de données massive après une attaque par ransomware": "Ransomware",
    "Attaque par déni de service sur le site": "DDoS",
    "Un logiciel malveillant a été trouvé": "Malware",
    "Deux comptes compromis": "Compromission de compte / messagerie",
    "La messagerie compromise d'un élu": "Compromission de compte / messagerie",
    "Sécurité : violation de données": "Fuite de données",
    "Données volées lors d'un piratage": "Fuite de données",
    "Campagne d'hameçonnage": "Phishing / fraude",
    "Incident chez un prestataire": "Incident tiers",
    "Piratage du site": "Intrusion",
    "Cyberattaque non démontrée": "Inconnu",
    "Aucune fuite de données, mais un piratage": "Intrusion",
    "Une enquête de cybersécurité": "Autre cyber",
    "Le conseil municipal vote le budget": "Inconnu",
    "un rapport de sport": "Inconnu",
}


def test_threats_have_their_fixed_names(spark):
    assert values(spark, list(THREATS), R.threat(searchable(F.col("t")))) == list(THREATS.values())
    assert [label for label, _ in P.THREAT_RULES] == [
        "Ransomware", "DDoS", "Malware", "Compromission de compte / messagerie", "Intrusion", "Fuite de données", "Phishing / fraude", "Incident tiers",
    ]


def test_threat_defaults(spark):
    rows = [
        ("texte neutre", "Fuite de données", "Fuite de données"), ("", "DDoS", "DDoS"), ("piratage", "Fuite de données", "Fuite de données"),
        ("phishing", "Fuite de données", "Phishing / fraude"), ("phishing", "Ransomware", "Ransomware"), ("phishing", None, "Phishing / fraude"),
        ("aucune compromission", "DDoS", "DDoS"),
    ]
    got = values(spark, rows, R.threat(searchable(F.col("t")), F.col("d")), "t string, d string, w string")
    assert got == [r[2] for r in rows]


@pytest.mark.parametrize(
    "text, plain",
    [("Sécurité", "Securite"), ("Sécurité", "Securite"), ("ế Ṽ ạ", "e V a"), ("ﬁn ﬃ ™", "fin ffi TM"), ("Ｆull", "Full"), ("Москва", "Москва"), ("œuvre ß", "œuvre ß"), (None, None)],
)
def test_accents(spark, text, plain):
    assert values(spark, [text], strip_accents(F.col("t"))) == [plain]


SOURCES = {
    "Santé": "Santé", " Sport ": "Sport", "oil & gas": "Énergie / Utilities", "Retail & e-commerce": "Commerce / Distribution", "Technology": "Numérique / Technologie",
    "Professional Services": "Services aux entreprises", "mairie": "Inconnu", "": "Inconnu", None: "Inconnu", "Inconnu": "Inconnu",
}
NAMES = {
    "Mairie Annexe": "Administration / Collectivité", "Rennes Métropole": "Administration / Collectivité", "Service public": "Administration / Collectivité",
    "Police municipale de Nice": "Administration / Collectivité", "Santé publique France": "Santé", "Agence régionale de santé": "Santé",
    "Office national du médicament": "Santé", "Hôpital Nord": "Santé", "Grand hôpital de Lyon": "Santé", "Université Paris 8": "Éducation / Formation",
    "Skema Business School": "Éducation / Formation", "Mutuelle des Îles": "Finance / Assurance", "Crédit Agricole": "Finance / Assurance",
    "Fédération française de rugby": "Sport", "Fédération française du bâtiment": "Inconnu", "Stade Français": "Sport", "Immo Tech Formation": "Inconnu",
    "": "Inconnu", None: "Inconnu",
}
ACTIVITIES = {
    "transport maritime et fret": "Transport / Logistique", "Institut national de prévention": "Santé", "éditeur de logiciels": "Numérique / Technologie",
    "cabinet d'avocats": "Services aux entreprises", "un rapport": "Inconnu", "club sportif et boutique": "Sport", "eau et assainissement": "Énergie / Utilities",
    "promoteur immobilier": "Construction / BTP", "usine de chimie": "Industrie / Manufacture", "": "Inconnu", None: "Inconnu",
}


@pytest.mark.parametrize("rule, cases", [(X.source_sector, SOURCES), (X.name_sector, NAMES), (X.activity_sector, ACTIVITIES)])
def test_sectors(spark, rule, cases):
    assert dict(zip(cases, values(spark, list(cases), rule(F.col("t"))), strict=True)) == cases


def test_sector_reads_texts_in_order_and_what_is_given_first(spark):
    rows = [
        ("Clinique", "mairie", "", "Santé"), ("rien", "mairie", "", "Administration / Collectivité"), ("Clinique", "mairie", "Sport", "Sport"),
        ("Clinique", "", "banking", "Finance / Assurance"), ("Clinique", "", "une usine", "Industrie / Manufacture"), ("Clinique", "", "rien", "Santé"),
        ("", None, None, "Inconnu"), ("Clinique", "", "Inconnu", "Inconnu"),
    ]
    got = values(spark, rows, X.sector([F.col("t"), F.col("u")], F.col("g")), "t string, u string, g string, w string")
    assert got == [r[3] for r in rows]


def test_watched_names_come_first(spark):
    rows = [("Hôpital Nord", "Sport", "Sport"), ("Hôpital Nord", "Inconnu", "Santé"), ("Hôpital Nord", "", "Santé"), ("Hôpital Nord", None, "Santé")]
    assert values(spark, rows, X.name_sector(F.col("t"), F.col("w")), "t string, w string, x string") == [r[2] for r in rows]


LOCATIONS = [
    # text, given, entity, default, place
    ("974 dossiers compromis", "", "", "", "Inconnu"), ("976 comptes exposés", "", "", "", "Inconnu"), ("Victime située au 97400 Saint-Denis", "", "", "", "La Réunion"),
    ("Entreprise du département 974", "", "", "", "La Réunion"), ("Victime située au 97600", "", "", "", "Mayotte"), ("Entreprise du département de 976", "", "", "", "Mayotte"),
    ("La Réunion touchée", "", "", "", "La Réunion"), ("la réunion de travail", "", "", "", "Inconnu"), ("LA REUNION", "", "", "", "La Réunion"), ("une entreprise réunionnaise", "", "", "", "La Réunion"),
    ("à Port-Louis", "", "", "France métropolitaine", "Maurice"), ("rien", "", "", "France métropolitaine", "France métropolitaine"), ("rien", "", "", "Paris", "Inconnu"),
    ("Mayotte", "Comores", "", "", "Comores"), ("Mayotte", "à Moroni", "", "", "Comores"), ("Mayotte", "Paris", "Madagascar", "", "Madagascar"), ("Mayotte", "Paris", "Paris", "", "Mayotte"),
    (None, None, None, None, "Inconnu"),
]


def test_locations(spark):
    got = values(
        spark, LOCATIONS, X.location([F.col("t")], given=F.col("g"), entity=F.col("e"), default=F.col("d")), "t string, g string, e string, d string, w string"
    )
    assert got == [r[4] for r in LOCATIONS]


def test_phrases_found_equal_plain_search(spark):
    rng = random.Random(3)
    words = ["a", "b", "c", "ab", "d"]
    phrases = {" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(30)}
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(200)] + [None]
    got = values(spark, texts, F.array_sort(phrases_in(F.col("t"), phrases)))
    assert got == [sorted(p for p in phrases if f" {p} " in f" {t or ''} ") for t in texts]
