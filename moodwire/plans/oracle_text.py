"""DuckDB SQL renderings of the text functions, for the correctness oracle.

They take the same rule tables as the Spark column functions but are written
for DuckDB (RE2 regexes, ``list_transform`` lambdas), so an agreement between
the two engines checks the Spark expressions independently.

Engine differences bridged here, exactly rather than by filtering rows:

* RE2 has no back-reference: ``([a-z])\\1\\1+`` becomes 26 rules ``x{3,}`` -> ``xx``.
* RE2's ``\\b`` is ASCII, Java 17's treats letters and digits of any script as
  word characters: ``\\bword\\b`` becomes explicit neighbour classes, applied twice
  so that occurrences sharing one delimiter are all replaced.
* Java ``\\S`` is ``[^ \\t\\n\\x0B\\f\\r]``; RE2's ``\\s`` lacks ``\\x0B``.
"""

from __future__ import annotations

import string

from moodwire.functions import rules

_WORD = r"[\p{L}\p{Nd}_]"
_NOT_WORD = r"[^\p{L}\p{Nd}_]"
_NOT_SPACE = r"[^ \t\n\x0B\f\r]"


def lit(s: str) -> str:
    out = s.replace("'", "''")
    return f"'{out}'"


def lower_replace(expr: str, pairs) -> str:
    out = f"lower({expr})"
    for k, v in pairs:
        out = f"replace({out}, {lit(k)}, {lit(v)})"
    return out


def normalize_sentiment(expr: str) -> str:
    return lower_replace(expr, rules.EMOTICONS)


def _bounded(pattern: str) -> str:
    core = pattern.removeprefix(r"\b").removesuffix(r"\b")
    return f"(^|{_NOT_WORD}){core}($|{_NOT_WORD})"


def normalize_shortforms(expr: str) -> str:
    out = f"lower({expr})"
    for pattern, repl in rules.SHORT_FORMS:
        rx = lit(_bounded(pattern))
        rp = lit("\\1" + repl + "\\2")
        for _ in range(2):
            out = f"regexp_replace({out}, {rx}, {rp}, 'g')"
    return out


def normalize_noise(expr: str, https: bool = False) -> str:
    out = f"lower({expr})"
    for ch in string.ascii_lowercase:
        out = f"regexp_replace({out}, '{ch}{{3,}}', '{ch}{ch}', 'g')"
    out = f"regexp_replace({out}, {lit('@' + _NOT_SPACE + '+')}, 'username', 'g')"
    scheme = "https?://" if https else "http://"
    out = f"regexp_replace({out}, {lit(scheme + _NOT_SPACE + '+')}, 'url', 'g')"
    out = f"regexp_replace({out}, '[-_]', ' ', 'g')"
    return out


def contains_any(expr: str, terms) -> str:
    return "(" + " OR ".join(f"contains({expr}, {lit(t)})" for t in terms) + ")"


def distant_label(expr: str) -> str:
    return f"CASE WHEN {contains_any(expr, rules.POSITIVE_TERMS)} THEN 1.0 ELSE 0.0 END"


# ----------------------------------------------------------------------------- stemmer

def _stem(w: str, n: int) -> str:
    return f"substr({w}, 1, length({w}) - {n})"


def _ends(w: str, suffix: str) -> str:
    return f"ends_with({w}, {lit(suffix)})"


def _rx(expr: str, pattern: str) -> str:
    return f"regexp_matches({expr}, {lit(pattern)})"


def _porter_steps() -> list[str]:
    w = "w"
    steps = [
        f"CASE WHEN length(w) < 3 THEN w || chr(3) "
        f"WHEN starts_with(w, 'y') THEN 'Y' || substr(w, 2) ELSE w END",
        f"CASE WHEN {_ends(w, 'sses')} THEN {_stem(w, 2)} WHEN {_ends(w, 'ies')} THEN {_stem(w, 2)} "
        f"WHEN {_ends(w, 'ss')} THEN w WHEN {_ends(w, 's')} THEN {_stem(w, 1)} ELSE w END",
        f"CASE WHEN {_ends(w, 'eed')} THEN (CASE WHEN {_rx(_stem(w, 3), rules.M_GT0)} THEN {_stem(w, 1)} ELSE w END) "
        f"WHEN {_ends(w, 'ed')} AND {_rx(_stem(w, 2), rules.HAS_VOWEL)} THEN {_stem(w, 2)} || chr(1) "
        f"WHEN {_ends(w, 'ing')} AND {_rx(_stem(w, 3), rules.HAS_VOWEL)} THEN {_stem(w, 3)} || chr(1) ELSE w END",
    ]
    s = _stem(w, 1)
    last = f"right({s}, 1)"
    double = (f"(length({s}) >= 2 AND {last} = substr({s}, length({s}) - 1, 1) "
              f"AND {last} NOT IN ('a','e','i','o','u','y'))")
    steps.append(
        f"CASE WHEN NOT ends_with(w, chr(1)) THEN w "
        f"WHEN {_ends(s, 'at')} OR {_ends(s, 'bl')} OR {_ends(s, 'iz')} THEN {s} || 'e' "
        f"WHEN {double} THEN (CASE WHEN {last} IN ('l','s','z') THEN {s} ELSE {_stem(s, 1)} END) "
        f"WHEN {_rx(s, rules.CVC_M1)} THEN {s} || 'e' ELSE {s} END")
    steps.append(f"CASE WHEN {_ends(w, 'y')} AND {_rx(_stem(w, 1), rules.HAS_VOWEL)} THEN {_stem(w, 1)} || 'i' ELSE w END")
    for table in (rules.PORTER_STEP2, rules.PORTER_STEP3):
        whens = " ".join(
            f"WHEN {_ends(w, suf)} THEN (CASE WHEN {_rx(_stem(w, len(suf)), rules.M_GT0)} "
            f"THEN {_stem(w, len(suf))} || {lit(rep)} ELSE w END)" for suf, rep in table)
        steps.append(f"CASE {whens} ELSE w END")
    whens = []
    for suf in rules.PORTER_STEP4:
        test = f"({_ends(w, 'sion')} OR {_ends(w, 'tion')})" if suf == "ion" else _ends(w, suf)
        whens.append(f"WHEN {test} THEN (CASE WHEN {_rx(_stem(w, len(suf)), rules.M_GT1)} "
                     f"THEN {_stem(w, len(suf))} ELSE w END)")
    steps.append(f"CASE {' '.join(whens)} ELSE w END")
    steps.append(
        f"CASE WHEN {_ends(w, 'e')} AND ({_rx(s, rules.M_GT1)} OR ({_rx(s, rules.M_EQ1)} "
        f"AND NOT {_rx(s, rules.CVC_M1)})) THEN {s} ELSE w END")
    w5 = f"(CASE WHEN {_ends(w, 'll')} AND {_rx(w, rules.M_GT1)} THEN {s} ELSE w END)"
    steps.append(
        f"CASE WHEN ends_with(w, chr(3)) THEN {s} "
        f"WHEN starts_with({w5}, 'Y') THEN 'y' || substr({w5}, 2) ELSE {w5} END")
    return steps


def stem_words(list_expr: str) -> str:
    out = list_expr
    for step in _porter_steps():
        out = f"list_transform({out}, lambda w: {step})"
    return out


def stem_text(expr: str) -> str:
    return f"array_to_string({stem_words(split_words(expr))}, ' ')"


# ----------------------------------------------------------------------------- tokenizers

def split_words(expr: str) -> str:
    return f"string_split(regexp_replace({expr}, ' +\\z', ''), ' ')"


def clean_words(list_expr: str, var: str = "t") -> str:
    return f"list_transform({list_expr}, lambda {var}: regexp_replace({var}, '\\W+', '', 'g'))"


def whitespace_unigrams(expr: str) -> str:
    ws = "[ \\t\\n\\x0B\\f\\r]"
    trimmed = f"regexp_replace({expr}, '^{ws}+|{ws}+\\z', '', 'g')"
    return (f"CASE WHEN {trimmed} = '' THEN []::VARCHAR[] "
            f"ELSE {clean_words(f'regexp_split_to_array({trimmed}, {chr(39)}{ws}+{chr(39)})')} END")


def unigrams(expr: str) -> str:
    return (f"CASE WHEN regexp_matches({expr}, '^ +\\z') THEN []::VARCHAR[] "
            f"ELSE {clean_words(split_words(expr))} END")


def ngrams(expr: str, n: int) -> str:
    sentences = (f"(CASE WHEN regexp_matches({expr}, '^\\.+\\z') THEN []::VARCHAR[] "
                 f"ELSE string_split(regexp_replace({expr}, '\\.+\\z', ''), '.') END)")
    trim = "regexp_replace(p, '^[\\x00-\\x20]+|[\\x00-\\x20]+\\z', '', 'g')"
    per_sentence = f"list_transform({sentences}, lambda p: {clean_words(f'string_split({trim}, chr(32))')})"
    windows = (f"list_transform({per_sentence}, lambda toks: list_transform("
               f"range(1, greatest(len(toks) - {n - 1}, 1) + 1), "
               f"lambda i: array_to_string(list_slice(toks, i, i + {n - 1}), ' ')))")
    return f"flatten({windows})"


def default_normalized(expr: str) -> str:
    return stem_text(normalize_noise(normalize_shortforms(normalize_sentiment(expr))))


def default_tokens_from_normalized(expr: str) -> str:
    return f"list_concat({unigrams(expr)}, {ngrams(expr, 2)})"
