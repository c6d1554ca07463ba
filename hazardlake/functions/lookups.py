"""Fixed values that results must reproduce exactly.

Everything in this module is data, not logic: the compass words used in
event narratives, the class names of the sentence classifier, the report
keywords, the seven impact ranges with their phrase text, and the x-axis
thresholds of the impact charts.
"""

from __future__ import annotations

# --- fixed values: compass abbreviation -> word (16 points) ---------------
COMPASS_WORDS = {
    "E": "East",
    "W": "West",
    "S": "South",
    "N": "North",
    "SE": "Southeast",
    "SW": "Southwest",
    "NE": "Northeast",
    "NW": "Northwest",
    "ESE": "East-Southeast",
    "WSW": "West-Southwest",
    "ENE": "East-Northeast",
    "WNW": "West-Northwest",
    "SSE": "South-Southeast",
    "SSW": "South-Southwest",
    "NNE": "North-Northeast",
    "NNW": "North-Northwest",
}

# --- fixed values: classifier classes, in class-index order ---------------
# The source model's second class carried a trailing space; we trim labels
# on read, so the stored names are clean.
CLASS_NAMES = ["buildings", "infrastructure", "other", "resilience"]

# Report sections, in report order, and the class each one summarizes.
SECTION_LABELS = [("Buildings", "buildings"),
                  ("Infrastructure", "infrastructure"),
                  ("Resilience", "resilience")]

# --- fixed values: title keywords for news articles -----------------------
NEWS_KEYWORDS = ["quake", "earthquake", "tremors"]

# --- fixed values: impact chart x thresholds (strictly greater-than) ------
# A box whose x is > 565 falls in bin 6, > 496 in bin 5, ... else bin 0.
IMPACT_X_THRESHOLDS = [220, 289, 358, 427, 496, 565]

# Boxes at least this wide or tall are chart furniture, not labels.
IMPACT_MAX_BOX_W = 60
IMPACT_MAX_BOX_H = 20

# --- fixed values: impact sentence text, bins 0..6 ------------------------
FATALITY_PREFIX = "USGS PAGER tool estimated the fatalities to be"
FATALITY_RANGES = [
    "smaller than 1",
    "between 1 and 10",
    "between 10 and 100",
    "between 100 and 1,000",
    "between 1,000 and 10,000",
    "between 10,000 and 100,000",
    "larger than 100,000",
]
LOSS_PREFIX = "Economic losses were expected to be"
LOSS_RANGES = [
    "smaller than $1 million",
    "between $1 million and $10 million",
    "between $10 million and $100 million",
    "between $100 million and $1,000 million",
    "between $1,000 million and $10,000 million",
    "between $10,000 million and $100,000 million",
    "larger than $100,000 million",
]
PROBABILITY_PHRASE = " with a probability of {}%"

# --- fixed values: HTML entities decoded in paragraph text ----------------
# "&amp;" is decoded last so that "&amp;lt;" stays the literal text "&lt;".
HTML_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]
