"""Proved activities (K-10) against cases with literal answers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions import phrases as P
from tidemark.operators import activity as X

SUBJECT = [
    ("Intermarché", "Intermarché est une enseigne de supermarchés française spécialisée dans le commerce alimentaire.", P.RETAIL, 9),
    ("Acme Cloud", "Nous sommes un éditeur de logiciels SaaS et proposons des services cloud aux entreprises.", P.TECH, 9),
    ("KparK", "KparK - N°1 de la rénovation de l'habitat, fenêtres, volets et portes sur-mesure.", P.CONSTRUCTION, 11),
    ("Chupin", "La SARL CHUPIN vous propose une large gamme de matériel agricole de qualité.", P.RETAIL, 9),
    ("Clenet", "CLENET - Vente et Location de solutions de manutention.", P.RETAIL, 9),
    ("EVA Nantes Sud", "Salles VR à Nantes | EVA Nantes Sud - Free roaming & esport en réalité virtuelle.", P.SPORT, 9),
    ("Acme Groupe", "Acme Groupe, leader européen du BTP et des concessions, développe les villes et territoires.", P.CONSTRUCTION, 11),
    ("STOR Solutions", "STOR Solutions travaille avec Iagona, son fournisseur, fabricant de solutions libre-service.", None, None),
    ("Acme", "Acme s'appuie sur Beta, partenaire spécialisé dans la construction et le génie civil.", None, None),
    ("Acme", "Acme travaille avec KparK, son fournisseur, spécialiste de la rénovation de l'habitat.", None, None),
    ("Acme VR", "Acme VR est une salle de réalité virtuelle proposant des expériences immersives.", None, None),
    ("Gamma", "Gamma est une banque; une usine.", P.FINANCE, 9),
    ("Gamma", "Gamma est une banque et une usine de papier.", None, None),
    ("Gamma", "Rien ici de connu.\nGamma est une ÉCOLE de commerce.", P.EDUCATION, 8),
    ("Gamma", "Gamma&nbsp;est une usine de papier.", P.INDUSTRY, 8),
    ("Delta", "Gamma est une banque de Lyon.", None, None),
    ("Gamma", "Gamma, usine", None, None),
    ("", "", None, None),
    (None, None, None, None),
]


@pytest.fixture(scope="module")
def proofs(spark):
    rows = [(i, org, text) for i, (org, text, _, _) in enumerate(SUBJECT)]
    df = spark.createDataFrame(rows, "i int, org string, text string")
    weak, strong = (X.subject_activity(F.col("org"), F.col("text"), least) for least in (X.LEAST_SCORE, X.STRONG_SCORE))
    return {r.i: r for r in df.select("i", weak.alias("weak"), strong.alias("strong")).collect()}


@pytest.mark.parametrize("i", range(len(SUBJECT)))
def test_subject(proofs, i):
    _, _, sector, score = SUBJECT[i]
    got = proofs[i]
    assert (got.weak and (got.weak.sector, got.weak.score)) == (sector and (sector, score))
    assert (got.strong and got.strong.sector) == (sector if score and score >= 10 else None)


def test_page(spark):
    texts = ["x " * 60 + "Notre usine de papier " + "y " * 90, "Une banque et une usine.", "Hôpital, banque", "L'usine.", None, "cciusine mairies"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.a and (r.a.sector, r.a.excerpt) for r in df.select("i", X.official_activity(F.col("t")).alias("a")).orderBy("i").collect()]
    long = texts[0]
    at = long.index("usine")
    assert got == [(P.INDUSTRY, long[at - 90 : at + 5 + 140].strip()), None, None, (P.INDUSTRY, "L'usine."), None, None]


def test_words_that_open_patterns():
    assert X.openings(("sports? federation", "[ée]cole", "préfecture", "e-commerce", "vente(?: et r)? de")) == ("e", "ecole", "prefecture", "sport", "sports", "vente")
    assert all(w.isascii() for _, _, a in X.WORDINGS + X.ACTIVITIES for w in X.openings(a))
