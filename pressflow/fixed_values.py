"""Fixed values of the data contract.

Everything here must hold exactly these values for results to be right: word lists,
lookup rows, thresholds, patterns and names. They are data, not logic.
"""

# Source -> ISO-3166 alpha-2 country; sources not listed are "XX".
SOURCE_COUNTRY = {
    "Hespress": "MA",
    "Akhbarona": "MA",
    "Lakom": "MA",
    "Barlamane": "MA",
    "BBC News": "GB",
    "BBC": "GB",
    "CNN": "US",
    "Reuters": "GB",
    "Al Jazeera": "QA",
}
UNKNOWN_COUNTRY = "XX"

# Words never counted as keywords (English, French, Arabic).
STOPWORDS = sorted(set("""
the a an and or of to in on for with at by from as is are was were be been being
this that these those it its their there here we you i he she they them his her
not no but if then else so do does did has have had will would can could should
about after again all also am any because before between both during each few
more most other our out over own same some such than too very what when where
which who why how
le la les un une des de du au aux et ou en sur dans pour avec par à ce ces ce
cet cette il elle ils elles nous vous je tu on son sa ses leur leurs y l c'est
qu pas plus mais ne ni si comme aussi très bien tout tous toute toutes a
في من على إلى عن مع هذا هذه ذلك تلك أن إن كان كانت يكون تكون قد قد كل بعض
""".split()))

# A keyword: three or more Latin (with accents) or Arabic-block characters.
KEYWORD_PATTERN = r"[A-Za-zÀ-ÿ\x{0600}-\x{06FF}]{3,}"
TOP_KEYWORDS_PER_DAY = 50
# What cleaning takes out of a text as an address.
URL_PATTERN = r"https?://\S+"

# Defaults put in place of nulls before gold is built.
UNKNOWN_SOURCE = "unknown"
UNKNOWN_LANGUAGE = "unknown"
UNKNOWN_THEME = "Uncategorized"

# Quality gates, in the order in which they are tried; the first that fails names the reject.
MIN_CONTENT_CHARS = 100
GATES = [
    ("missing_title", "completeness"),
    ("missing_date", "completeness"),
    ("invalid_date", "validity"),
    ("content_too_short", "validity"),
]
CORRUPT_JSON = "corrupt_json"

# Language is not guessed for texts with fewer characters than this.
MIN_LANGUAGE_CHARS = 20

# Feed items taken from the head of each feed document.
MAX_ITEMS_PER_FEED = 15

# Name of the raw event stream.
RAW_TOPIC = "raw_articles"

# The characters Python counts as whitespace, as a regex class that Java and RE2 both read.
WHITESPACE = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# The same characters, for functions that take a set of characters.
WHITESPACE_CHARS = "".join(
    chr(c)
    for lo, hi in [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
                   (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
                   (0x3000, 0x3000)]
    for c in range(lo, hi + 1)
)
