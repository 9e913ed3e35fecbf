"""Rule-based scoring and classification of job text as native Column expressions.

All functions take the combined job text (see ``text.combined_text``) and return a
Column; nothing here leaves the JVM. Two regex dialects matter:

* the word-scoring rules (leadership, years, inferred years, skills) treat letters
  of any script as word characters, so the Java patterns carry ``(?U)`` and
  ``(?d)`` (``.`` stops only at LF);
* the category and seniority rules use an ASCII word boundary, which Java lacks,
  so ``\\b`` is rewritten to explicit ASCII look-arounds.

One scan decides which rules are worth trying. ``rule_hits`` finds, in one pass over the lower-cased text, the literal beginnings of all
rule terms; a rule's own pattern runs only where one of its beginnings was found. Most texts hold few of them, so most rules
never read the text. The scan finds every place where a term can match (it knows ASCII word boundaries only, which
each Unicode boundary next to an ASCII letter is too), so results are those of the patterns alone.

``rule_patterns(dialect="re2")`` gives the same rules for an RE2 engine, which
the oracle SQL in ``__spark_entry__`` uses.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobloom.functions import vocab as V

_ASCII_WORD = "[A-Za-z0-9_]"
_ASCII_BOUNDARY = (
    f"(?:(?<={_ASCII_WORD})(?!{_ASCII_WORD})|(?<!{_ASCII_WORD})(?={_ASCII_WORD}))"
)
_UNICODE_FLAGS = "(?U)(?d)"


def _whole_words(terms: list[str]) -> str:
    return r"\b(?:" + "|".join(terms) + r")\b"


def _any_of(terms: list[str]) -> str:
    return "|".join(terms)


_WORD_CHAR = re.compile(r"[A-Za-z0-9_]")


def _ascii_boundaries(fragment: str) -> str:
    """Rewrite ``\\b`` (ASCII word boundary) for Java.

    Next to a literal word character a boundary is one look-around: before it,
    "no word character behind"; after it, "no word character ahead". Anywhere
    else (e.g. after an optional ``.``) the two-sided form is used.
    """
    out, i = [], 0
    while i < len(fragment):
        if fragment.startswith(r"\b", i):
            nxt = fragment[i + 2:i + 3]
            prev = fragment[i - 1:i] if i else ""
            prev_escaped = i >= 2 and fragment[i - 2] == "\\"
            if nxt and _WORD_CHAR.match(nxt) and not fragment.startswith(r"\b", i + 2):
                out.append(f"(?<!{_ASCII_WORD})")
            elif prev and _WORD_CHAR.match(prev) and not prev_escaped:
                out.append(f"(?!{_ASCII_WORD})")
            else:
                out.append(_ASCII_BOUNDARY)
            i += 2
        else:
            out.append(fragment[i])
            i += 1
    return "".join(out)


def rule_patterns(dialect: str = "java") -> dict:
    """Regex text of every rule, for ``java`` (Spark) or ``re2`` (DuckDB)."""
    java = dialect == "java"
    uni = _UNICODE_FLAGS if java else ""
    ascii_b = (lambda p: "(?d)" + "|".join(_ascii_boundaries(t) for t in p.split("|"))) if java else (lambda p: p)
    return {
        "leadership": [(score, uni + _whole_words(terms)) for score, terms in V.LEADERSHIP_TIERS],
        "inferred": [(yrs, uni + _whole_words(terms)) for yrs, terms in V.INFERRED_YEARS_TIERS],
        "years": [("(?i)" + uni + p if java else "(?i)" + p) for p in V.YEARS_PATTERNS],
        "skills": ("(?i)" + uni if java else "(?i)") + _whole_words(V.SKILLS),
        "category": [(label, ascii_b(_any_of(terms))) for label, terms in V.CATEGORY_RULES],
        "seniority": [(label, ascii_b(_any_of(terms))) for label, terms in V.SENIORITY_RULES],
    }


_P = rule_patterns("java")


# ----------------------------------------------------------------- one scan for all rules
_LONG_S = "\u017f"  # the one letter that matches an ASCII letter in another case and stays as it is in lower case


def _beginning(term: str, whole_word: bool) -> tuple[str, bool, bool]:
    """(literal that every match of ``term`` begins with, whether a word begins there, whether one ends behind it)."""
    left = whole_word or term.startswith(r"\b")
    body = term.removeprefix(r"\b")
    out, i, complete = "", 0, True
    while i < len(body):
        if body.startswith(r"\b", i):
            break
        step = 2 if body[i] == "\\" else 1
        letter = body[i + step - 1]
        optional = body[i + step:i + step + 1] == "?"
        if optional or (step == 1 and letter in ".["):
            complete = False
            break
        out, i = out + letter, i + step
    ends = complete and (whole_word or body.endswith(r"\b")) and bool(_WORD_CHAR.match(out[-1]))
    return out, left and bool(_WORD_CHAR.match(out[0])), ends


def _literals() -> dict[str, tuple[bool, bool]]:
    """Beginnings of all terms: literal -> (only where a word begins, only where one ends behind it)."""
    whole = [t for _, terms in (*V.LEADERSHIP_TIERS, *V.INFERRED_YEARS_TIERS) for t in terms] + V.SKILLS
    anywhere = [t for _, terms in (*V.CATEGORY_RULES, *V.SENIORITY_RULES) for t in terms]
    found: dict[str, tuple[bool, bool]] = {"year": (False, False), "yr": (False, False)}
    for term, kind in [(t, True) for t in whole] + [(t, False) for t in anywhere]:
        literal, left, right = _beginning(term, kind)
        old = found.get(literal, (True, True))
        found[literal] = (old[0] and left, old[1] and right)
    return found


def _scan_pattern(literals: dict[str, tuple[bool, bool]]) -> str:
    """At each place the longest literal: alternatives by first letter, long ones first. What follows is not consumed."""
    groups = []
    for first in sorted({x[0] for x in literals}):
        parts = []
        for text in sorted((x for x in literals if x[0] == first), key=lambda x: (-len(x), x)):
            left, right = literals[text]
            parts.append((f"(?<!{_ASCII_WORD}{re.escape(first)})" if left else "") + re.escape(text[1:]) + (f"(?!{_ASCII_WORD})" if right else ""))
        groups.append(f"{re.escape(first)}(?:{'|'.join(parts)})")
    return f"(?=({'|'.join(groups)}))"


_LITERALS = _literals()
_SCAN = _scan_pattern(_LITERALS)


def rule_hits(lowered: Column) -> Column:
    """The distinct literal beginnings of rule terms in a lower-cased text: the one scan."""
    return F.array_distinct(F.regexp_extract_all(lowered, F.lit(_SCAN), F.lit(1)))


def _may(hits: Column | None, literals) -> Column | None:
    """Can a term that begins with one of ``literals`` match? A longer literal found at a place stands for its beginnings."""
    if hits is None:
        return None
    names = sorted({h for h in _LITERALS if any(h.startswith(x) for x in literals)})
    return F.arrays_overlap(hits, F.array(*[F.lit(n) for n in names]))


def _first_match(text: Column, rules: list, default, hits: Column | None = None, terms: list | None = None, whole_words: bool = True) -> Column:
    expr = None
    for (value, pattern), (_, words) in zip(rules, terms or rules, strict=True):
        cond = F.regexp_like(text, F.lit(pattern))
        if hits is not None:
            cond = _may(hits, {_beginning(w, whole_words)[0] for w in words}) & cond
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(default))


def leadership_score(text: Column, lowered: Column | None = None, hits: Column | None = None) -> Column:
    """0-40 leadership signal; empty text scores 10 (SCR-1). ``lowered`` = ``lower(text)`` and ``hits`` = ``rule_hits(lowered)``
    when the caller already has them."""
    lc = F.lower(text) if lowered is None else lowered
    return F.when(text == "", F.lit(V.LEADERSHIP_EMPTY_TEXT)).otherwise(
        _first_match(lc, _P["leadership"], V.LEADERSHIP_DEFAULT, hits, V.LEADERSHIP_TIERS)
    )


def _years_groups(pattern: str) -> int:
    return pattern.count("(") - pattern.count("(?")


def max_years(text: Column, hits: Column | None = None) -> Column:
    """Largest number in an explicit years phrase, capped at 25, else 0 (SCR-2)."""
    found = []
    for p in _P["years"]:
        for g in range(1, _years_groups(p) + 1):
            found.append(F.regexp_extract_all(text, F.lit(p), F.lit(g)))
    numbers = F.concat(*found).try_cast("array<int>")  # element-wise; no lambda, stays in codegen
    best = F.least(F.coalesce(F.array_max(numbers), F.lit(0)), F.lit(V.YEARS_CAP))
    return best if hits is None else F.when(_may(hits, {"year", "yr"}), best).otherwise(F.lit(0))


def inferred_years(text: Column, explicit_years: Column | None = None, lowered: Column | None = None, hits: Column | None = None) -> Column:
    """Years guessed from seniority words when none are stated (SCR-3)."""
    explicit_years = max_years(text) if explicit_years is None else explicit_years
    lc = F.lower(text) if lowered is None else lowered
    guess = _first_match(lc, _P["inferred"], V.INFERRED_YEARS_DEFAULT, hits, V.INFERRED_YEARS_TIERS)
    return F.when((text == "") | (explicit_years > 0), F.lit(0)).otherwise(guess)


def count_skills(text: Column, lowered: Column | None = None, hits: Column | None = None) -> Column:
    """Number of distinct skill tokens, compared lower-case (SCR-4).

    Matching the case-insensitive pattern on the lower-cased text finds the same
    tokens, already lower-cased, so no per-match lambda is needed.
    """
    lc = F.lower(text) if lowered is None else lowered
    count = F.size(F.array_distinct(F.regexp_extract_all(lc, F.lit(_P["skills"]), F.lit(0))))
    if hits is None:
        return count
    may = _may(hits, {_beginning(t, True)[0] for t in V.SKILLS}) | F.contains(lc, F.lit(_LONG_S))
    return F.when(may, count).when(text.isNotNull(), F.lit(0)).otherwise(count)


def complexity_score(lead: Column, years: Column, inferred: Column, skills: Column) -> Column:
    """Combine the four signals into the 0-100 integer score (SCR-5)."""
    years_pts = F.least(F.greatest(years, inferred) * V.YEARS_WEIGHT, F.lit(V.YEARS_POINTS_CAP))
    skill_pts = F.least(skills * V.SKILL_WEIGHT, F.lit(V.SKILL_POINTS_CAP))
    return F.least(F.lit(V.SCORE_CAP), lead + years_pts + skill_pts).cast("int")


def category(text: Column, lowered: Column | None = None, hits: Column | None = None) -> Column:
    """Job family label (SCR-6)."""
    return _first_match(F.lower(text) if lowered is None else lowered, _P["category"], V.CATEGORY_DEFAULT, hits, V.CATEGORY_RULES, False)


def seniority_level(text: Column, lowered: Column | None = None, hits: Column | None = None) -> Column:
    """Seniority label (SCR-7)."""
    return _first_match(F.lower(text) if lowered is None else lowered, _P["seniority"], V.SENIORITY_DEFAULT, hits, V.SENIORITY_RULES, False)


def _sql_first_match(text: str, rules: list, default) -> str:
    lit = (lambda v: f"'{v}'") if isinstance(default, str) else str
    arms = " ".join(f"WHEN regexp_like({text}, r'{p}') THEN {lit(v)}" for v, p in rules)
    return f"CASE {arms} ELSE {lit(default)} END"


def sql_bodies() -> dict[str, tuple[str, str]]:
    """SQL text of each scorer over a STRING argument ``t``: name -> (type, body)."""
    years_items = ", ".join(
        f"regexp_extract_all(t, r'{p}', {g})"
        for p in _P["years"] for g in range(1, _years_groups(p) + 1))
    years = (f"least(coalesce(array_max(try_cast(concat({years_items}) AS ARRAY<INT>)), 0), "
             f"{V.YEARS_CAP})")
    return {
        "leadership_kw_score": ("INT", f"CASE WHEN t = '' THEN {V.LEADERSHIP_EMPTY_TEXT} ELSE "
                                f"{_sql_first_match('lower(t)', _P['leadership'], V.LEADERSHIP_DEFAULT)} END"),
        "max_years": ("INT", years),
        "inferred_years_if_missing": ("INT", f"CASE WHEN t = '' OR {years} > 0 THEN 0 ELSE "
                                      f"{_sql_first_match('lower(t)', _P['inferred'], V.INFERRED_YEARS_DEFAULT)} END"),
        "count_skills": ("INT", f"size(array_distinct(regexp_extract_all(lower(t), r'{_P['skills']}', 0)))"),
        "job_category": ("STRING", _sql_first_match("lower(t)", _P["category"], V.CATEGORY_DEFAULT)),
        "job_seniority": ("STRING", _sql_first_match("lower(t)", _P["seniority"], V.SENIORITY_DEFAULT)),
    }


def register_sql_functions(spark) -> None:
    """Expose the scorers to SQL users as temporary SQL functions (UDF-1).

    ``CREATE TEMPORARY FUNCTION ... RETURN`` bodies are inlined by the analyzer, so
    ``SELECT leadership_kw_score(t)`` plans like the Column version: no Python.
    """
    for name, (ret, body) in sql_bodies().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS {ret} RETURN {body}")
