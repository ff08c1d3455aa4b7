"""Victims of entries (X-04), names by titles, denials, campaigns and activities against literal answers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import victims as V

#: (title, summary, content, victim, found_in)
ENTRIES = [
    ("DGFiP : une 2ème cyberattaque", None, None, "DGFiP", "title"),
    ("Son-Video.com frappé une nouvelle fois par une cyberattaque", "", "", "Son-Video.com", "title"),
    ("Alinto : une fuite massive touche les entreprises", "", "", "Alinto", "title"),
    ("Cyberattaque à Gagny : la Ville confirme un accès non autorisé", "La Ville de Gagny confirme avoir subi une cyberattaque.", "", "Ville de Gagny", "relation"),
    ("Cyberattaque dans une collectivité", "La Ville de Test confirme avoir subi une cyberattaque.", "", "Ville de Test", "relation"),
    ("Cyberattaque à Drancy : tous les serveurs débranchés", "", "La mairie de Drancy fait face à une importante attaque par rançongiciel.", "Mairie de Drancy", "content"),
    ("Services perturbés", "", "Le CHM a été victime d'une cyberattaque.", "CHM", "content"),
    ("Services perturbés", "", "Le CHX a été victime d'une cyberattaque.", None, None),
    ("La mairie d’Eyguières paralysée par un ransomware", "", "", "Mairie d’Eyguières", "relation"),
    ("Le Domaine des Tournels ciblé par une cyberattaque", "", "", "Domaine des Tournels", "title"),
    ("284 461 membres de la Fédération Française de Bridge diffusés après une faille de sécurité", "", "", "Fédération Française de Bridge", "relation"),
    ("Fuite de données scolaires : près de 15 000 élèves concernés", "", "", None, None),
    ("4 SDIS frappés : 5 000 pompiers exposés", "", "", None, None),
    ("Une IA d’OpenAI s’échappe de son environnement de test et pirate Hugging Face", "", "", None, None),
    ("Le site de Pierrefitte-sur-Loire mis hors ligne après une cyberattaque", "", "", None, None),
    ("Steam : noms exposés après une cyberattaque", "Valve avertit des clients de Steam après une cyberattaque contre CEVA Logistics.", "", "Steam", "title"),
    ("Centres Sociaux de France : les données revendiquées après une compromission de RezoFed", "", "", "Centres Sociaux de France", "title"),
    ("Toulouse FC : les abonnés exposés après une cyberattaque chez un prestataire", "", "", "Toulouse FC", "title"),
    ("École Directe : fausse alerte à la cyberattaque", "", "", None, None),
    ("Mon Espace Santé : une fuite évoquée", "Aucune preuve technique ne permet de confirmer la compromission.", "", None, None),
    ("Direction générale des Finances publiques confirme avoir été victime d'une cyberattaque", "", "", "Direction générale des Finances publiques", "relation"),
    ("Ville de Test confirme être victime d'une cyberattaque", "", "", "Ville de Test", "relation"),
    ("Chat Control : une proposition controversée", "", "", None, None),
    ("1001Coques : victimes d'une cyberattaque", "", "", "1001Coques", "title"),
    ("5doigts2pieds.fr piraté : données exposées", "", "", "5doigts2pieds.fr", "title"),
    ("Rapport technique sur un prestataire", "Air Austral est cité parmi plusieurs clients de la société.", "", None, None),
    ("Amis de la police : la base exposée", "L'Amicale Police et Patrimoine prévient.", "", "Amicale Police et Patrimoine", "title"),
    ("Le fusil volé : l'Armurerie Dupont confirme une cyberattaque", "", "", "Armurerie Dupont", "title"),
    ("Alerte", "Une attaque visant Acme SAS, hier.", "", "Acme SAS", "relation"),
    (None, None, None, None, None),
    ("", "", "x" * 100_000, None, None),
]


def test_victims(spark):
    rows = [(i, *e[:3]) for i, e in enumerate(ENTRIES)]
    df = spark.createDataFrame(rows, "i int, title string, summary string, content string")
    known = spark.createDataFrame([("chm",), ("chm",), (None,)], "key string")
    got = {r.i: (r.victim, r.found_in) for r in V.victims(df, known, "i", "title", "summary", "content").collect()}
    assert got == {i: e[3:] for i, e in enumerate(ENTRIES)}
    assert V.victims(df, known.limit(0), "i", "title", "summary", "content").filter("i = 6 AND victim IS NULL").count() == 1
    assert V.victims(df.limit(0), known, "i", "title", "summary", "content").count() == 0


#: (title, summary, content, denied, campaign)
MARKED = [
    ("Association.fr : la fuite revendiquée ne correspond pas aux données du site", "", "", True, False),
    ("A", "", "Aucune intrusion chez le tiers.", False, False),
    ("A", "", "Revendication démentie.", True, False),
    ("G7 d’Évian : plusieurs sites concernés", None, None, False, True),
    ("Son-Video.com & EasyLounge : données exposées", None, None, False, True),
    ("Alerte régionale", "Plusieurs ARS concernées", None, False, True),
    ("Cyberattaque à Rennes", "Ville de Rennes et Rennes Métropole affectées", None, False, True),
    ("ARS et cybersécurité", "130 hôpitaux", "dont l'AP-HP", False, True),
    ("Les ARS", "130 hôpitaux", "dont l'AP-HP", False, False),
    (None, None, None, False, False),
]


def test_denials_and_campaigns(spark):
    df = spark.createDataFrame([(i, *m[:3]) for i, m in enumerate(MARKED)], "i int, t string, s string, c string")
    cols = [F.col(x) for x in "tsc"]
    got = df.select("i", V.denied(*cols).alias("d"), V.campaign(*cols).alias("m")).orderBy("i").collect()
    assert [(r.d, r.m) for r in got] == [m[3:] for m in MARKED]


#: (title, before the colon, as a title)
TITLES = [
    ("Impact Centre Chrétien frappé par Qilin", "", "Impact Centre Chrétien"),
    ("Acme SAS : des données volées", "Acme SAS", "Acme SAS : des données volées"),
    ("Alerte : rien", "", "Alerte : rien"),
    ("Ransomware", "", ""),
    ("Une phrase de plus de six mots entiers : x", "", "Une phrase de plus de six mots entiers : x"),
    ("Piratage Acme : x", "", "Piratage Acme : x"),
    ("a b c d e f g h i j k l m", "", ""),
    ("🔴 Acme (Lyon) piratée", "", "Acme"),
    (None, "", ""),
]


def test_titles(spark):
    df = spark.createDataFrame([(i, t[0]) for i, t in enumerate(TITLES)], "i int, t string")
    got = df.select("i", V.name_before_colon(F.col("t")).alias("a"), V.name_as_title(F.col("t")).alias("b")).orderBy("i").collect()
    assert [(r.a, r.b) for r in got[:7] + got[8:]] == [t[1:] for t in TITLES[:7] + TITLES[8:]]
    # places are those of the searchable form, which has lost the sign and its space
    assert got[7].b.startswith("Acme")


HALLS = [
    ("Hier, la mairie de Saint-Leu a été victime d'une cyberattaque.", "mairie de Saint-Leu"),
    ("Une cyberattaque contre Mairie de Sainte-Rose, hier", "Mairie de Sainte-Rose"),
    ("La mairie de Saint-Leu alerte.", ""),
    (None, ""),
]


def test_town_halls(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(HALLS)], "i int, t string")
    assert [r.n for r in df.select("i", V.town_hall(F.col("t")).alias("n")).orderBy("i").collect()] == [n for _, n in HALLS]


#: (organisation, first text, second text, activity)
SAID = [
    ("Acme", "Acme est une entreprise spécialisée dans la vente de pneus, à Lyon.", None, "spécialisée dans la vente de pneus"),
    ("Acme", "Acme, éditeur de logiciels.", None, "éditeur de logiciels"),
    ("Acme", "Acme travaille avec Beta, éditeur de logiciels.", None, ""),
    ("Acme", "L'éditeur de logiciels Acme.", None, ""),
    ("Acme", "Rien. Acme (club sportif) ferme.", None, "club sportif"),
    ("Acme", "Rien.", "Beta vend.\nACME est un acteur de la santé; fin", "acteur de la santé"),
    ("Acme", "Acme et Beta, éditeur de x y z. Acme est un organisme public.", None, "organisme public"),
    ("", "Acme, éditeur de logiciels.", None, ""),
    (None, None, None, ""),
]


@pytest.mark.parametrize("both", [False, True])
def test_activities(spark, both):
    df = spark.createDataFrame([(i, *s[:3]) for i, s in enumerate(SAID)], "i int, o string, a string, b string")
    got = df.select("i", V.victim_activity(F.col("o"), F.col("a"), F.col("b")).alias("x")).orderBy("i").collect()
    assert [r.x for r in got] == [s[3] for s in SAID]
    if both:
        loose = df.select("i", V.activity_phrase(F.col("a")).alias("x")).orderBy("i").collect()
        assert [loose[i].x for i in (2, 3, 4, 8)] == ["éditeur de logiciels", "éditeur de logiciels Acme", "club sportif", ""]


#: (title, body, organisation, names a victim)
LOCAL = [
    ("La mairie alerte", "La mairie de X victime d'une cyberattaque", "Mairie de X", True),
    ("La mairie alerte sur un piratage", "", "Mairie de X", False),
    ("Alerte : la mairie victime d'un piratage", "", "Mairie de X", True),
    ("Piratage à la mairie", "", "Mairie de X", True),
    ("Une mairie ouvre", "", "Mairie de X", False),
    ("Piratage", "", "", False),
    (None, None, None, False),
]


def test_local_titles(spark):
    df = spark.createDataFrame([(i, *x[:3]) for i, x in enumerate(LOCAL)], "i int, t string, b string, o string")
    got = df.select("i", V.names_victim(F.col("t"), F.col("b"), F.col("o")).alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == [x[3] for x in LOCAL]
