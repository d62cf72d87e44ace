"""Rule tables of the text chain.

Everything in this module is data. The values that must equal the
behaviour being reproduced are stated plainly, in their natural order,
under the "fixed values" markers; the code that applies them lives in
``moodwire.functions.text`` (Spark) and ``moodwire.plans.oracle`` (DuckDB).
"""

from __future__ import annotations

GOOD, BAD, SAD = "good", "bad", "sad"

# ---------------------------------------------------------------------------
# Emoticon / emoji dictionary, literal (not regex) replacement,
# applied in this order after lower-casing. 44 entries. Keys holding an
# upper-case letter can never match after lower-casing; they are kept as is.
# ---------------------------------------------------------------------------
EMOTICONS: list[tuple[str, str]] = [
    # positive
    (":)", GOOD),
    (":-)", GOOD),
    ("&lt;3", GOOD),
    (" ->d", GOOD),
    (" ->dd", GOOD),
    ("8)", GOOD),
    (" ->-)", GOOD),
    (" ->)", GOOD),
    (";)", GOOD),
    (";-)", GOOD),
    ("(- ->", GOOD),
    ("( ->", GOOD),
    ("\U0001F603", GOOD),  # smiling face with open mouth
    ("\U0001F604", GOOD),  # smiling face with open mouth and smiling eyes
    ("\U0001F60A", GOOD),  # smiling face with smiling eyes
    ("\U0001F600", GOOD),  # grinning face
    ("\U0001F617", GOOD),  # kissing face
    ("\U0001F61B", GOOD),  # face with stuck-out tongue
    ("☺", GOOD),  # white smiling face
    ("✌", GOOD),  # victory hand
    ("❤", GOOD),  # heavy black heart
    ("⭐", GOOD),  # white medium star
    ("\U0001F44D", GOOD),  # thumbs up sign
    ("\U0001F44C", GOOD),  # ok hand sign
    ("\U0001F44F", GOOD),  # clapping hands sign
    ("\U0001F602", GOOD),  # face with tears of joy
    ("\U0001F606", GOOD),  # smiling face with open mouth and tightly-closed eyes
    ("\U0001F60B", GOOD),  # face savouring delicious food
    ("\U0001F60D", GOOD),  # smiling face with heart-shaped eyes
    # negative
    ("\U0001F61F", BAD),  # worried face
    ("\U0001F626", BAD),  # frowning face with open mouth
    ("\U0001F627", BAD),  # anguished face
    ("\U0001F615", BAD),  # confused face
    ("\U0001F61E", BAD),  # disappointed face
    ("\U0001F620", BAD),  # angry face
    ("\U0001F622", SAD),  # crying face
    ("\U0001F621", SAD),  # pouting face
    (" ->/", BAD),
    (" ->&gt;", SAD),
    (" ->')", SAD),
    (" ->-(", BAD),
    (" ->(", BAD),
    (" ->S", BAD),
    (" ->-S", BAD),
]

# ---------------------------------------------------------------------------
# Short forms, Java regular expressions applied in this order.
# ---------------------------------------------------------------------------
SHORT_FORMS: list[tuple[str, str]] = [
    (r"\byou're\b", "you are"),
    (r"\bu\b", "you"),
    (r"\bhaha\b", "ha"),
    (r"\bhahaha\b", "ha"),
    (r"\bdon't\b", "do not"),
    (r"\bdoesn't\b", "does not"),
    (r"\bdidn't\b", "did not"),
    (r"\bhasn't\b", "has not"),
    (r"\bhaven't\b", "have not"),
    (r"\bhadn't\b", "had not"),
    (r"\bwon't\b", "will not"),
    (r"\bwouldn't\b", "would not"),
    (r"\bcan't\b", "can not"),
    (r"\bcannot\b", "can not"),
]

# ---------------------------------------------------------------------------
# Noise rules, Java regular expressions applied in this order.
# ---------------------------------------------------------------------------
NOISE: list[tuple[str, str]] = [
    (r"([a-z])\1\1+", "$1$1"),  # a letter repeated 3+ times -> twice
    (r"@\S+", "username"),
    (r"http:\/\/\S+", "url"),
    (r"[-_]", " "),
]

# ---------------------------------------------------------------------------
# Emoticons that label a text (distant supervision) and that
# select the status stream.
# ---------------------------------------------------------------------------
POSITIVE_TERMS: list[str] = [":)", ":-)", ";-)", ";)"]
NEGATIVE_TERMS: list[str] = [":(", ":-("]
TRACKED_TERMS: list[str] = POSITIVE_TERMS + NEGATIVE_TERMS

# Display threshold of a prediction: below it the tweet is shown negative.
DISPLAY_THRESHOLD = 0.51

# Defaults of the trainers.
ONLINE_FEATURES = 1500
SGD_ITERATIONS = 200
SGD_STEP = 1.0
SGD_CONVERGENCE_TOL = 0.001
BATCH_GRID_FEATURES = [10, 100, 1000]
BATCH_GRID_REG = [0.1, 0.01]
BATCH_FOLDS = 2
BATCH_MAX_ITER = 10
CORPUS_TARGET = 500
SEARCH_LIMIT = 100
STATISTICS_SECONDS = 5  # interval of the online model's evaluation

# ---------------------------------------------------------------------------
# Porter stemmer (published algorithm, M. F. Porter 1980, with the two
# departures of the author's reference implementation: bli->ble, logi->log).
# Each table is (suffix, replacement); within a table the first suffix that
# ends the word is the only one tried, so longer suffixes come first where one
# ends another.
# ---------------------------------------------------------------------------
PORTER_STEP2: list[tuple[str, str]] = [
    ("ational", "ate"), ("tional", "tion"),
    ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
]
PORTER_STEP3: list[tuple[str, str]] = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"),
    ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""),
    ("ness", ""),
]
# Step 4 removes the suffix when the stem has measure > 1; "ion" only after s or t.
PORTER_STEP4: list[str] = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]

# Measure regexes (no look-around, no back-reference: same text in Java and RE2).
# "\\z" is the very end; Java's "$" would also match before a final newline.
_C = "[^aeiou][^aeiouy]*"  # consonant sequence
_V = "[aeiouy][aeiou]*"  # vowel sequence
M_GT0 = f"^({_C})?{_V}{_C}"
M_EQ1 = f"^({_C})?{_V}{_C}({_V})?\\z"
M_GT1 = f"^({_C})?{_V}{_C}{_V}{_C}"
HAS_VOWEL = f"^({_C})?[aeiouy]"
CVC_M1 = f"^{_C}[aeiouy][^aeiouwxy]\\z"  # measure 1 and ends consonant-vowel-consonant
