"""Example lexicon. Common French function words and a few inflected forms."""

_STOP = (
    "de la le les et un une des du en au aux est que qui dans pour par sur avec ce se il elle on ne pas "
    "plus ou mais nous vous ils elles son sa ses leur leurs comme tout"
).split()

_FORMS = (
    ("communes", "communes", "NOUN", False),
    ("villages", "villages", "NOUN", False),
    ("lycées", "lycér", "NOUN", False),
    ("scolaires", "scolaire", "ADJ", False),
    ("écoles", "école", "NOUN", False),
    ("vie", "vie", "NOUN", False),
    ("jours", "jour", "NOUN", False),
    ("années", "année", "NOUN", False),
    ("vivre", "vivre", "VERB", False),
    ("voiture", "voiture", "NOUN", False),
    ("calme", "calme", "ADJ", False),
    ("mange", "manger", "VERB", False),
    ("the", "the", "DET", False),
    ("and", "and", "CCONJ", False),
)

ROWS = [(word, word, "DET", True) for word in _STOP] + list(_FORMS)
