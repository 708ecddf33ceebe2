"""Word lists, lookup tables, thresholds and formats the results depend on."""

# --- fixed values: text rules -------------------------------------------------------------------
# Lemmas that carry no information about a city, on top of the lexicon's own stop flags.
UNINFORMATIVE_LEMMAS = (
    "faire", "falloir", "voir", "trouver", "aller", "venir", "être", "avoir",
    "pouvoir", "devoir", "mettre", "passer", "rester", "sortir", "vivre", "vie",
    "an", "année", "temps", "fois", "moment", "jour", "mois",
    "point", "niveau",
)

# Wrong lemmas and their correction, applied before FORM_NORMALISATION.
LEMMA_CORRECTIONS = {
    "manqu": "manque",
    "lycér": "lycée",
    "lycé": "lycée",
    "médiathèqu": "médiathèque",
    "facillté": "facilité",
    "réaménagemer": "réaménagement",
    "pari": "paris",
}

# Plural and derived forms folded onto one word.
FORM_NORMALISATION = {
    "commun": "commune",
    "communes": "commune",
    "communal": "commune",
    "communale": "commune",
    "communaux": "commune",
    "villages": "village",
    "villageois": "village",
    "commerces": "commerce",
    "commercial": "commerce",
    "commerciaux": "commerce",
    "commerciale": "commerce",
    "scolaire": "école",
    "scolaires": "école",
    "sportifs": "sportif",
    "sportives": "sportif",
    "culturels": "culturel",
    "culturelles": "culturel",
    "transports": "transport",
}

CONTENT_POS = ("NOUN", "ADJ", "PROPN")
MIN_WORD_LENGTH = 3
CITY_WORDS = 150
AREA_WORDS = 50

# --- fixed values: sentiment --------------------------------------------------------------------
POSITIVE_FROM = 4.0
NEGATIVE_UPTO = 2.0
SENTIMENTS = ("positive", "neutral", "negative")
SENTIMENT_LABELS = {"positive": "Positif", "neutral": "Neutre", "negative": "Négatif"}
SENTIMENT_COLOURS = {"positive": "green", "neutral": "gray", "negative": "red"}

# --- fixed values: scores -----------------------------------------------------------------------
SCORES = ("mean", "safety", "education", "sport_leisure", "environment", "practical_life")
CATEGORIES = SCORES[1:]
# Text a page uses for each category, matched as a substring of the lower-cased label, in order.
CATEGORY_LABELS = {
    "safety": "sécurité",
    "education": "éducation",
    "sport_leisure": "sport",
    "environment": "environnement",
    "practical_life": "vie pratique",
}
ANONYMOUS = "Anonyme"

# --- fixed values: territory --------------------------------------------------------------------
LEVELS = ("city", "department", "region")
LEVEL_TITLES = {"city": "Villes", "department": "Départements", "region": "Régions"}
LEVEL_PATHS = {"city": "cities", "department": "departments", "region": "regions"}
DEPARTMENT_LABEL = "Département "
REGION_LABEL = "Région "
# City code -> codes of its districts.
AGGLOMERATIONS = {
    "75056": tuple(str(code) for code in range(75101, 75121)),
    "13055": tuple(str(code) for code in range(13201, 13217)),
}
AGGLOMERATION_NAMES = ("Paris", "Marseille")
DISTRICT_PREFIXES = ("Paris ", "Marseille ")

# --- fixed values: prices, maps -----------------------------------------------------------------
MIN_PRICE = 500.0
MAX_FEATURES = 500
MAX_POINTS = 750
REGION_ZOOM = 6
DEPARTMENT_ZOOM = 9
EARTH_RADIUS = 6378137.0
NEUTRAL_COLOUR = "#888888"
SATISFACTION_SCALE = (5.0, 2.5)

# --- fixed values: page addresses ---------------------------------------------------------------
CITY_URL = r"^https?://[^/]+/[^/]+-\d+/avis\.html$"
CITY_CODE_IN_URL = r"/[^/]+-(\d+)/avis\.html"
QUARTER_MARK = "/quartier-"
DISTRICT_MARK = "arrondissement"
REVIEW_COUNT = r"sur (\d+) commentaires"
