"""Fixed phrase tables: threats, markers of the cyber domain and of its physical lookalikes, negations, statuses.

All phrases are searchable text (T-02). The values are fixed, as results depend on them; they stand in natural order.
"""

from __future__ import annotations

RANSOMWARE, DDOS, MALWARE, ACCOUNT, INTRUSION, LEAK, PHISHING, THIRD_PARTY, OTHER, UNKNOWN = (
    "Ransomware", "DDoS", "Malware", "Compromission de compte / messagerie", "Intrusion", "Fuite de données", "Phishing / fraude",
    "Incident tiers", "Autre cyber", "Inconnu",
)

RANSOMWARE_GROUPS = (
    "lockbit", "alphv", "blackcat", "clop", "cl0p", "play", "akira", "8base", "medusa", "rhysida", "black basta", "royal",
    "bianlian", "hunters", "qilin", "inc ransom", "ransomhub", "cactus", "noescape", "everest", "stormous", "trigona",
    "vice society", "conti", "revil", "hive", "blackbyte", "daixin", "dragonforce", "safepay", "brain cipher",
)

#: K-02: threat, phrases.
THREAT_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    (RANSOMWARE, ("ransomware", "rancongiciel", "rancon", "ransom", "chiffrement des donnees", "donnees chiffrees", *RANSOMWARE_GROUPS)),
    (DDOS, ("ddos", "d dos", "deni de service", "denial of service", "attaque par saturation")),
    (MALWARE, ("malware", "logiciel malveillant", "virus informatique", "trojan", "cheval de troie", "spyware", "infostealer", "rootkit", "botnet")),
    (ACCOUNT, (
        "messagerie compromise", "compte compromis", "comptes compromis", "boite mail piratee", "compte pirate", "usurpation de compte",
        "identifiants voles", "credential", "account takeover", "compromission de la messagerie", "piratage de compte",
    )),
    (INTRUSION, (
        "intrusion", "acces non autorise", "compromission du systeme", "compromission si", "systeme d information compromis",
        "unauthorized access", "piratage informatique", "cyberattaque", "cyber attaque", "attaque informatique", "hacking", "piratage",
        "attaque par un groupe",
    )),
    (LEAK, (
        "fuite de donnees", "fuite massive", "exfiltration", "data breach", "donnees exposees", "donnees personnelles exposees",
        "base de donnees exposee", "vol de donnees", "donnees derobees", "leak", "violation de donnees", "mis en vente", "mise en vente",
        "en vente", "donnees diffusees", "diffusees publiquement", "donnees revendiquees", "documents exposes", "comptes exposes",
        "utilisateurs exposes", "coordonnees exposees", "pieces d identite exposees",
        "donnees volees", "donnees exfiltrees", "donnees publiees", "data leak", "fichiers diffuses",
    )),
    (PHISHING, ("phishing", "hameconnage", "fraude", "arnaque", "escroquerie", "scam", "smishing", "faux site", "usurpation d identite")),
    (THIRD_PARTY, ("prestataire", "sous traitant", "fournisseur", "chez son hebergeur", "third party", "supply chain", "chaine d approvisionnement")),
)
#: Threats that win over a source's default, the first that matches.
SPECIFIC = (RANSOMWARE, DDOS, MALWARE, ACCOUNT, LEAK, PHISHING, THIRD_PARTY)

CYBER_PREFIXES = (
    "cyber", "pirat", "hack", "ransomware", "rancongiciel", "phish", "hameconn", "malware", "ddos", "intrusion", "exfiltr", "rgpd", "cnil",
    "spyware", "botnet", "keylogger", "cryptolock",
)
AMBIGUOUS_PREFIXES = ("intrusion", "hack")
CYBER_PHRASES = (
    "fuite de donnees", "vol de donnees", "violation de donnees", "donnees personnelles", "donnees exposees", "donnees volees",
    "base de donnees exposee", "data breach", "data leak", "incident informatique", "incident de securite", "security incident",
    "securite informatique", "securite des systemes", "attaque informatique", "systeme d information", "logiciel malveillant",
    "deni de service", "denial of service", "messagerie compromise", "compte compromis", "comptes compromis", "usurpation d identite",
    "identifiants voles", "acces non autorise", "unauthorized access", "arnaque en ligne", "escroquerie en ligne", "faux site",
)
PHYSICAL_MARKERS = (
    "cambriolage", "cambriolages", "cambrioleur", "cambrioleurs", "cambriole", "effraction", "effractions", "nocturne", "nocturnes",
    "s introduire", "porte fracturee", "vitre brisee", "coffre fort", "burglary", "break in", "voleurs", "malfaiteurs", "domicile",
    "commercant", "fourriere", "interpellation", "interpellations", "interpelles", "garde a vue", "gendarmerie", "commissariat",
    "degradations", "vol de materiel", "squat", "squatteurs", "grillage", "entrepot",
)
#: F-04: claims that are denied in so many words.
NEGATIONS = (
    r"\b(?:aucune|aucun|pas de|sans)\s+fuite(?: de donnees)?\b",
    r"\baucune\s+donnee(?:s)?(?: [a-z]+){0,4}\s+exposee(?:s)?\b",
    r"\b(?:aucune|aucun|pas de|sans)\s+compromission\b",
    r"\bcyberattaque\s+non\s+(?:demontree|demontre)\b",
    r"\borigine\s+cyber\s+non\s+(?:demontree|demontre)\b",
    r"\baucun\s+element(?: [a-z]+){0,4}\s+(?:ne\s+)?(?:demontre|demontrant)\s+une\s+cyberattaque\b",
)
#: What each of them denies: a text with none of these words has no such denial.
NEGATED_CLAIMS = ("fuite", "exposee", "compromission", "cyberattaque", "origine cyber")
#: K-16: status of a claim, the first pattern that matches.
CLAIM_STATUS = (
    (r"non\s+confirm[ée]e?", "unconfirmed"),
    (r"d[ée]menti[e]?", "denied"),
    (r"confirm[ée]e?", "confirmed"),
    (r"revendiqu[ée]e?", "claimed"),
)
CVE = r"CVE-\d{4}-\d{4,7}"
CVSS = r"CVSS[:\s]*(?:score\s*)?(?:de\s*)?(\d{1,2}(?:[.,]\d)?)(?:\s*/\s*10)?"
VOLUME = r"\d[\d\s ,.]*\s*(?:Ko|Mo|Go|To|KB|MB|GB|TB)"
FILE_COUNT = r"(\d[\d\s .,]*)\s*(?:fichiers?|documents?)"

#: F-10: words that name no actor, and how phrases that name none begin.
ACTOR_SENTINELS = (
    "", "un", "une", "le", "la", "les", "hacker", "le hacker", "un hacker", "attaquant", "l attaquant", "auteur", "inconnu", "non identifie",
    "non identifie publiquement", "n a", "na", "ransomware", "rancongiciel", "cybercriminel", "cybercriminels", "pirate", "pirates",
)
ACTOR_OPENINGS = ("le hacker", "un hacker", "l attaquant", "un attaquant")
#: F-11.
THIRD_PARTY_SENTINELS = ("", "un", "une", "le", "la", "les", "inconnu")
#: K-03...K-11: sectors.
ADMIN, HEALTH, EDUCATION, FINANCE, TRANSPORT, SPORT, RETAIL, TECH, ENERGY, INDUSTRY, CONSTRUCTION, SERVICES = SECTORS = (
    "Administration / Collectivité", "Santé", "Éducation / Formation", "Finance / Assurance", "Transport / Logistique", "Sport",
    "Commerce / Distribution", "Numérique / Technologie", "Énergie / Utilities", "Industrie / Manufacture", "Construction / BTP",
    "Services aux entreprises",
)
#: K-04: names of activities as sources give them, in searchable form, by sector.
ACTIVITY_NAMES: tuple[tuple[str, tuple[str, ...]], ...] = (
    (INDUSTRY, ("manufacturing", "industrial machinery", "machinery", "metals mining", "chemicals", "automotive", "aerospace defense", "electronics", "food beverages")),
    (CONSTRUCTION, ("construction", "real estate")),
    (SERVICES, ("business services", "legal services", "law firms", "accounting", "staffing recruiting")),
    (HEALTH, ("healthcare", "hospital health care", "pharmaceuticals", "biotechnology")),
    (EDUCATION, ("education",)),
    (FINANCE, ("finance", "financial services", "banking", "insurance")),
    (RETAIL, ("retail", "wholesale", "consumer goods")),
    (TRANSPORT, ("transportation", "logistics supply chain", "shipping", "airlines aviation")),
    (ADMIN, ("government", "government administration", "public administration")),
    (TECH, ("it services", "information technology", "software", "telecommunications", "media internet")),
    (ENERGY, ("energy utilities", "energy", "utilities", "oil gas")),
    (SPORT, ("sports",)),
)
#: K-04 alone: names that structured sources use besides.
STRUCTURED_NAMES = ((SERVICES, ("professional services",)), (TECH, ("technology",)), (RETAIL, ("retail e commerce",)))
#: K-05: phrases that tell a sector from a name alone, all but sport, for which names need more.
NAME_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    (ADMIN, (
        "mairie de", "ville de", "commune de", "ministere de", "ministere des", "prefecture de", "conseil departemental", "conseil regional",
        "departement de", "police nationale", "police municipale", "gendarmerie nationale", "sapeurs pompiers", "service departemental d incendie",
    )),
    (HEALTH, ("centre hospitalier", "hopital de", "clinique de", "clinique du", "hospices civils")),
    (EDUCATION, ("universite de", "ecole de", "ecole superieure", "college de", "lycee", "academie de", "rectorat de")),
    (FINANCE, ("banque de", "caisse d epargne", "credit agricole")),
)
#: K-05: how names of institutions begin, the first sector whose opening fits; a space at the end asks for another word.
HEALTH_OPENINGS = (
    "agence regionale de sante", "centre hospitalier ", "centre d imagerie medicale ", "centre imagerie medicale ", "clinique ", "hopital ",
    "hospices civils ", "federation hospitaliere ",
)
ADMIN_OPENINGS = (
    "mairie ", "ville de ", "ville d ", "commune de ", "commune d ", "the commune of ", "ministere de ", "ministere des ", "ministry of ",
    "fr ministry of ", "prefecture de ", "metropole de ", "metropole ", "region ", "la region ", "departement de ", "conseil departemental ",
    "centre communal d action sociale ", "service public ", "france services",
)
EDUCATION_OPENINGS = (
    "universite ", "university of ", "ecole nationale ", "ecole superieure ", "ecole elementaire ", "ecole ", "academie de ", "rectorat de ",
    "lycee ", "college ", "campus france", "paris school of business", "ppa business school", "enseignement catholique", "sciences po",
)
SPORT_FEDERATIONS = ("federation francaise ", "federation nationale ")
SPORT_TERMS = (
    "football", "rugby", "handball", "basket", "basketball", "volley", "tennis", "golf", "karate", "judo", "aikido", "motocyclisme", "cyclisme",
    "danse", "voile", "escrime", "randonnee", "natation", "athletisme", "gymnastique", "gym", "badminton", "hockey", "chasse", "equitation", "bridge",
    "savate", "ski", "vol libre", "aeronautique", "escalade", "twirling", "squash", "ulm", "pagaie", "handisport", "tennis de table",
    "sport automobile", "sport universitaire", "sport scolaire", "sport", "sports",
)
#: K-05, K-06: an institution with a mission in health.
HEALTH_BODIES = ("agence nationale", "agence regionale", "etablissement public", "autorite", "office national", "institut national")
HEALTH_MISSIONS = ("sante", "sanitaire", "medical", "medicament", "pharmacie", "hospitalier", "prevention")
#: K-03, K-06: phrases of an activity.
ACTIVITY_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    (ADMIN, (
        "mairie", "ville de", "commune", "communaute d agglomeration", "departement", "region", "ministere", "prefecture", "prefet", "collectivite",
        "municipalite", "conseil departemental", "conseil regional", "gouvernement", "government", "administration", "caf", "cgss",
        "securite sociale", "caisse d allocations", "mairie de", "council", "municipal", "police", "gendarmerie", "pompiers", "sdis",
        "sapeurs pompiers", "service departemental d incendie", "protection civile", "ambassade", "consulat", "prefectorale", "agence nationale",
    )),
    (HEALTH, (
        "chu", "chr", "hopital", "hospitalier", "clinique", "sante", "laboratoire", "ehpad", "medical", "medecine", "pharmacie", "hospital",
        "health", "ars",
    )),
    (EDUCATION, (
        "universite", "university", "ecole", "college", "lycee", "enseignement", "academie", "rectorat", "formation", "campus", "school",
        "education", "institut",
    )),
    (FINANCE, (
        "banque", "bank", "assurance", "insurance", "mutuelle", "courtage", "finance", "financier", "credit", "tresor", "impots", "fiscal", "douane",
        "revenue authority", "microfinance",
    )),
    (TRANSPORT, (
        "compagnie aerienne", "airlines", "airways", "aeroport", "air austral", "airport", "port maritime", "grand port", "portuaire", "transport",
        "transports", "entreposage", "logistique", "logistics", "fret", "maritime", "shipping",
    )),
    (SPORT, ("federation francaise de", "federation francaise d", "club sportif", "federation sportive", "sport", "fitness", "olympique", "football")),
    (RETAIL, (
        "cci", "chambre de commerce", "commerce", "commerces", "distribution", "enseigne", "supermarche", "supermarches", "hypermarche",
        "hypermarches", "magasin", "magasins", "retail", "boutique", "boutiques", "e commerce", "chambre de metiers", "concession",
        "concessionnaire", "automobiles", "garage", "grande surface", "centre commercial", "negoce", "grossiste",
    )),
    (TECH, (
        "technologies", "technology", "reseaux", "editeur de logiciels", "esn", "cloud", "logiciel", "software", "saas", "numerique", "telecom",
        "telecommunication", "operateur mobile", "technologie", "tech", "informatique", "hebergeur", "datacenter", "orange", "sfr", "zeop",
        "emtel", "telma", "airtel",
    )),
    (ENERGY, (
        "energie", "energy", "electricite", "electricity", "edf", "eau", "water", "assainissement", "utilities", "jirama", "runeo", "cise",
        "petrole", "gaz",
    )),
    (CONSTRUCTION, (
        "batiment", "btp", "travaux publics", "construction", "immobilier", "immobiliers", "immobiliere", "immobilieres", "agence immobiliere",
        "maconnerie", "charpente", "promoteur immobilier", "immo", "habitat", "logement", "hlm", "bailleur social", "foncier",
    )),
    (INDUSTRY, (
        "industrie", "industriel", "manufacture", "usine", "fonderie", "metallurgie", "chimie", "agroalimentaire", "automobile", "aeronautique",
        "fabricant",
    )),
    (SERVICES, (
        "cabinet d avocats", "cabinet comptable", "expertise comptable", "notaire", "huissier", "conseil en", "interim", "recrutement", "nettoyage",
        "securite privee", "ordre des", "avocats", "groupement", "cooperative", "chambre syndicale",
    )),
)
#: K-07, K-08: places, and phrases that tell one from a text.
FRANCE, REUNION, MAYOTTE, MAURITIUS, MADAGASCAR, SEYCHELLES, COMOROS = PLACES = (
    "France métropolitaine", "La Réunion", "Mayotte", "Maurice", "Madagascar", "Seychelles", "Comores",
)
PLACE_HINTS: tuple[tuple[str, tuple[str, ...]], ...] = (
    (REUNION, ("saint denis de la reunion", "reunionnais", "reunionnaise")),
    (MAYOTTE, ("mayotte", "mamoudzou", "mahorais", "mahoraise")),
    (MAURITIUS, ("mauritius", "mauricien", "mauricienne", "port louis", "rodrigues")),
    (MADAGASCAR, ("madagascar", "malgache", "antananarivo", "tananarive")),
    (SEYCHELLES, ("seychelles", "seychellois", "seychelloise", "victoria mahe")),
    (COMOROS, ("comores", "comorien", "comorienne", "moroni", "anjouan")),
    (FRANCE, ("france metropolitaine",)),
)
#: K-08: the island's name in its own case; postal codes and departments in a searchable text.
REUNION_NAME = r"(?U)\b(?:La R[ée]union|LA R[ÉE]UNION)\b"
DEPARTMENTS = ((REUNION, "974"), (MAYOTTE, "976"))

#: K-11: NAF section, sector. Sections that say too little are unknown.
NAF_SECTORS = {
    "C": "Industrie / Manufacture", "D": "Énergie / Utilities", "E": "Énergie / Utilities", "F": "Construction / BTP", "G": "Commerce / Distribution",
    "H": "Transport / Logistique", "J": "Numérique / Technologie", "K": "Finance / Assurance", "M": "Services aux entreprises",
    "N": "Services aux entreprises", "O": "Administration / Collectivité", "P": "Éducation / Formation", "Q": "Santé",
}
#: K-15: sensitivity of a data type, the first tier of which a marker stands in it.
SENSITIVITY = (
    ("critical", (
        "mot de passe", "mots de passe", "password", "hash", "token", "otp", "secret", "cle api", "authent", "sante", "medical", "patient", "diagnostic",
        "patholog", "ordonnance", "traitement", "vaccin", "nir", "securite sociale", "passeport", "carte d identite", "cartes d identite",
        "piece d identite", "pieces d identite", "permis de conduire", "biometr", "selfie",
    )),
    ("high", ("iban", "rib", "bancair", "carte de paiement", "cartes de paiement", "carte bancaire", "cartes bancaires", "releve de compte", "revenu", "salaire", "patrimoine")),
    ("moderate", ("mail", "telephone", "mobile", "adresse", "numero client", "identifiant client", "date de naissance", "naissance")),
)
#: K-17: modality of a sentence, the first pattern that matches.
MODALITY = (
    ("denied", r"(?:d[ée]ment|d[ée]menti|nie|nient|conteste|contestent)"),
    ("hypothesis", r"(?:pourrait|pourraient|susceptible|potentiellement|possible|hypoth[èe]se|serait|seraient|aurait|auraient)"),
    ("negated", r"(?:n['’ ](?:a|ont|est|sont)\s+pas|ne\s+.{0,40}\s+pas|aucun(?:e)?|sans\s+(?:preuve|confirmation)|non\s+touch[ée]|pas\s+touch[ée])"),
    ("confirmed", r"(?:confirme|confirm[ée]e?s?|reconna[iî]t|reconnu|admet|admis|officiellement)"),
    ("claimed", r"(?:revendiqu[ée]e?s?|affirme|affirment|dit\s+avoir|selon\s+(?:l['’]?attaquant|le\s+groupe|les\s+pirates?))"),
    ("reported", r"(?:rapport[ée]e?s?|indique|indiquent|selon\s+(?:le|la|les|un|une)\s+)"),
)

#: X-10: unit of a count, what it counts.
COUNT_UNITS = {
    "personne": "people", "personnes": "people", "victime": "people", "victimes": "people", "membre": "people", "membres": "people", "agent": "people",
    "agents": "people", "compte": "accounts", "comptes": "accounts", "utilisateur": "users", "utilisateurs": "users", "client": "clients", "clients": "clients",
    "employe": "people", "employes": "people", "salarie": "people", "salaries": "people", "patient": "people", "patients": "people", "eleve": "people",
    "eleves": "people", "abonne": "people", "abonnes": "people", "enregistrement": "records", "enregistrements": "records", "ligne": "records",
    "lignes": "records", "dossier": "files", "dossiers": "files", "fichier": "files", "fichiers": "files",
}
#: X-12: data types by pattern, and what a sentence must hold for one to count.
DATA_TYPES = (
    ("adresses e-mail", r"\b(?:adresses?\s+)?e-?mails?|courriels?\b"),
    ("numéros de téléphone", r"\b(?:num[ée]ros?\s+de\s+)?t[ée]l[ée]phones?\b"),
    ("adresses postales", r"\badresses?\s+(?:postales?|physiques?)\b"),
    ("noms et prénoms", r"\bnoms?\b.{0,30}\bpr[ée]noms?\b|\bpr[ée]noms?\b"),
    ("dates de naissance", r"\bdates?\s+de\s+naissance\b"),
    ("identifiants", r"\bidentifiants?(?:\s+de\s+connexion)?\b"),
    ("mots de passe", r"\bmots?\s+de\s+passe|passwords?\b"),
    ("données bancaires", r"\b(?:donn[ée]es?|coordonn[ée]es?)\s+bancaires?|\bIBAN\b|\bRIB\b"),
    ("données de santé", r"\bdonn[ée]es?\s+(?:de\s+sant[ée]|m[ée]dicales?)\b"),
    ("pièces d'identité", r"\bpi[èe]ces?\s+d['’ ]identit[ée]|passeports?\b"),
)
TYPE_TRIGGER = r"\b(?:donn[ée]es?|fuite|vol|expos|comprom|exfiltr|publi|concern|contiend|inclu)"
