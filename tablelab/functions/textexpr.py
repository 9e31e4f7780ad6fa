"""Text expressions: tokens, style counts, cleaning rules.

``ascii=True`` treats only ASCII letters and digits as word characters; ``ascii=False`` is Unicode-aware.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import count_literal, count_regex, ratio, replace_all

# Patterns below write \< and \> for the start and end of a word. The JVM's \b is Unicode-aware while
# its \w is not, so ASCII patterns spell the two boundaries out.
WORD_START, WORD_END = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"


def _re(pattern: str, ascii: bool) -> str:
    if ascii:
        return pattern.replace(r"\<", WORD_START).replace(r"\>", WORD_END)
    return "(?U)" + pattern.replace(r"\<", r"\b").replace(r"\>", r"\b")


def letters_and_digits(col: Column) -> Column:
    """Everything that is neither a letter nor a digit becomes a space (Unicode)."""
    return F.regexp_replace(col, r"[^\p{IsAlphabetic}\p{Nd}]", " ")


def tokens(col: Column, ascii: bool = True, min_length: int = 3) -> Column:
    """Lower-cased words in text order, without short ones and without those holding a digit."""
    words = F.split(col, _re(r"\W+", ascii))
    lowered = F.transform(words, lambda w: F.lower(w))
    return F.filter(lowered, lambda w: (F.char_length(w) >= min_length) & ~w.rlike("[0-9]"))


# Style counts as (name, pattern, is_regex).
STYLE_COUNTS = [
    ("use_cap", "[A-Z]", True),
    ("use_lower", "[a-z]", True),
    ("use_exl", "!", False),
    ("use_space", " ", False),
    ("use_double_space", "  ", False),
    ("use_quest", "?", False),
    ("use_punt", None, True),
    ("use_digit", None, True),
    ("use_break", "\n", False),
    ("use_word", r"\w+", True),
    ("use_symbol", "[&@#$%*^]", True),
    ("use_char", r"\W*\<\w\>\W*", True),
    ("use_i", r"\<[Ii]\>", True),
    ("use_emotj", "[:;=]-?[)DP]", True),
]


def style_counts(col: Column, ascii: bool = True) -> dict[str, Column]:
    """Counts of each pattern by itself; ``style_steps`` gives the same numbers with fewer scans."""
    special = {
        "use_punt": r"\p{Punct}" if ascii else r"\p{P}",
        "use_digit": "[0-9]" if ascii else r"\p{Nd}",
    }
    out = {"length": F.char_length(col)}
    for name, pattern, is_regex in STYLE_COUNTS:
        if not is_regex:
            out[name] = count_literal(col, pattern)
        else:
            out[name] = count_regex(col, _re(pattern or special[name], ascii or name in ("use_cap", "use_lower")))
    return out


def style_steps(col: Column, ascii: bool = True) -> tuple[list[dict[str, Column]], dict[str, Column]]:
    """Columns to add one after another and the counts of ``style_counts`` over the last of them.

    Runs of small letters shrink to two, which keeps all words as single or longer ones and all neighbours of other
    characters. What is counted by its kind alone is then counted as what a removal shortens, the frequent kinds first.
    """
    c, n = F.col, F.char_length
    word, punct, digit = ("\\w", "\\p{Punct}", "[0-9]") if ascii else ("(?U)\\w", "\\p{P}", "\\p{Nd}")
    cut = lambda name, pattern: F.regexp_replace(name, pattern + "+", "")
    steps = [
        {"__length": n(col), "__short": F.regexp_replace(col, "[a-z]{3,}", "aa")},
        # each longer word is two zeros; without them only words of one character are left
        {"__words": F.regexp_replace("__short", word + "{2,}", "00"), "__no_lower": cut("__short", "[a-z]")},
        {"__singles": F.replace("__words", F.lit("00"), F.lit("")), "__no_letter": cut("__no_lower", "[A-Z]")},
        {"__other": F.replace("__no_letter", F.lit(" "), F.lit(""))},
        {"__char": n("__singles") - n(cut("__singles", word))},
    ]
    removed = lambda name, pattern: n(name) - n(cut(name, pattern))
    out = {
        "length": c("__length"),
        "use_cap": n("__no_lower") - n("__no_letter"),
        "use_lower": c("__length") - n("__no_lower"),
        "use_exl": count_literal(c("__other"), "!"),
        "use_space": n("__no_letter") - n("__other"),
        "use_double_space": F.shiftright(n("__short") - n(F.replace("__short", F.lit("  "), F.lit(""))), 1),
        "use_quest": count_literal(c("__other"), "?"),
        "use_punt": removed("__other", punct),
        "use_digit": removed("__other", digit),
        "use_break": count_literal(c("__other"), "\n"),
        "use_word": F.shiftright(n("__words") - n("__singles"), 1) + c("__char"),
        "use_symbol": removed("__other", "[&@#$%*^]"),
        "use_char": c("__char"),
        "use_i": count_literal(c("__singles"), "I") + count_literal(c("__singles"), "i"),
        "use_emotj": count_regex(c("__short"), "[:;=]-?[)DP]"),
    }
    return steps, out


def style_ratios() -> dict[str, Column]:
    """Ratios over the count columns; 0 where undefined."""
    c = F.col
    out = {
        "cap_len": ratio(c("use_cap"), c("length")),
        "low_len": ratio(c("use_lower"), c("length")),
        "cap_rate": ratio(c("use_cap"), c("use_lower")),
        "digit_len": ratio(c("use_digit"), c("length")),
        "i_len": ratio(c("use_i"), c("length")),
        "char_len": ratio(c("use_char"), c("length")),
        "symbol_len": ratio(c("use_symbol"), c("length")),
        "cap_emo": ratio(c("use_emotj"), c("length")),
    }
    out["cap_odds"] = ratio(out["cap_len"], out["low_len"])
    return out


# Cleaning rules in the order they apply, as (pattern, replacement).
LINKS = [(r"(f|ht)tp(s?)://\S+", " "), (r"http\S+", ""), (r"xml\S+", "")]
PAIRED_SPACE = [(r"[ \t\n\f\r]{2}", " ")]
SHORT_FORMS = [
    ("what's", "what is "), ("'s", " is "), ("'ve", " have "), ("can't", "cannot "), ("n't", " not "),
    ("i'm", "i am "), ("'re", " are "), ("'d", " would "), ("'ll", " will "), ("'scuse", " excuse "),
    ("pleas", " please "), ("sourc", " source "), ("peopl", " people "), ("remov", " remove "),
]
INTERJECTIONS = [
    (r"(a|e)w+\>", ""), (r"(y)a+\>", ""), (r"(w)w+\>", ""), (r"((a+)|(h+))(a+)((h+)?)\>", ""), (r"((lol)(o?))+\>", ""),
]
SPLIT_SUFFIXES = [
    (r"(?<=\<(fu|su|di|co|li))\s(?=(ck)\>)", ""), (r"(?<=\w(ck))\s(?=(ing)\>)", ""), (r"(?<=\<\w)\s(?=\w\>)", ""),
]
LAUGHTER = [(r"((lol)(o?))+", "")]
SPLIT_SUFFIXES_AGAIN = [
    (r"(?<=\<(fu|su|di|co|li))\s(?=(ck)\>)", ""), (r"(?<=\w(uc))\s(?=(ing)\>)", ""),
    (r"(?<=\<(fu|su|di|co|li))\s(?=(ck)\w)", ""), (r"(?<=\<(fu|su|di|co|li))\s(?=(k)\w)", "c"),
]
MENTIONS_DIGITS_BREAKS_ASCII = [(r"@\w+", " "), (r"[0-9]", " "), (r"\n", " ")]
MENTIONS_DIGITS_BREAKS = [(r"@\w+", " "), (r"\p{Nd}", " "), (r"\n", " ")]
NON_WORDS_ASCII = [(r"[^\p{Graph}]", " "), (r"\p{Punct}", " "), (r"[^A-Za-z0-9]", " ")]
NON_WORDS = [(r"[^\p{Graph}]", " "), (r"\p{P}", " "), (r"[^\p{IsAlphabetic}\p{Nd}]", " ")]
SHORT_WORDS = [(r"\W*\<\w\>\W*", " "), (r"\<\w{1,2}\>", " ")]
SPACE_RUNS = [(r"[ \t\n\f\r]{2}", " "), (r"[ \t\n\f\r]+", " ")]


def cleaning_rules(pairs: Sequence[tuple[str, str]] = (), repair: bool = True, ascii: bool = True) -> list[tuple[str, str]]:
    """All rules in order. ``pairs`` joins spaced-out words (literal text → text); ``repair`` adds the
    look-around rules that close gaps inside words."""
    literal = [("\\Q" + a + "\\E", b.replace("\\", "\\\\").replace("$", "\\$")) for a, b in pairs]
    rules = [*LINKS, *PAIRED_SPACE, *SHORT_FORMS, *PAIRED_SPACE, *INTERJECTIONS, *literal]
    rules += [*(SPLIT_SUFFIXES if repair else []), *LAUGHTER, *(SPLIT_SUFFIXES_AGAIN if repair else [])]
    rules += [*(MENTIONS_DIGITS_BREAKS_ASCII if ascii else MENTIONS_DIGITS_BREAKS)]
    rules += [*(NON_WORDS_ASCII if ascii else NON_WORDS), *SHORT_WORDS, *SPACE_RUNS]
    return [(p if p.startswith("\\Q") else _re(p, ascii), r) for p, r in rules]


def _one_by_one(kinds: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Compiled rules that turn single characters into a space."""
    return [r for r in kinds if not r[0].startswith("@")]


def quick_rules(rules: Sequence[tuple[str, str]], ascii: bool = True) -> list[tuple[str, str, bool]]:
    """The same rewriting with fewer scans of the text, as (pattern, replacement, is_regex).

    Digits, breaks and all kinds of non-words become spaces one after another and leave only letters; one class says
    so. A pattern without any operator is replaced as plain text, and a gap is found before what stands around it.
    """
    breaks, non_words = (MENTIONS_DIGITS_BREAKS_ASCII, NON_WORDS_ASCII) if ascii else (MENTIONS_DIGITS_BREAKS, NON_WORDS)
    run = [(_re(p, ascii), r) for p, r in [*_one_by_one(breaks), *non_words]]
    rules, out, at = list(rules), [], 0
    while at < len(rules):
        pattern, replacement = rules[at]
        if rules[at : at + len(run)] == run:
            out.append(("[^A-Za-z]" if ascii else r"[^\p{IsAlphabetic}]", " ", True))
            at += len(run)
            continue
        quoted = pattern.startswith("\\Q") and pattern.endswith("\\E")
        plain = pattern[2:-2] if quoted else pattern.removeprefix("(?U)")
        if plain and "\\" not in replacement and "$" not in replacement and (quoted and "\\E" not in plain or re.fullmatch(r"[A-Za-z' ]+", plain)):
            out.append((plain, replacement, False))
        else:
            # the blank comes first, so that look-behinds run at blanks only
            gap = re.fullmatch(r"(\(\?U\))?\(\?<=(.*)\)\\s\(\?=(.*)\)", pattern)
            out.append((f"{gap[1] or ''}\\s(?={gap[3]})(?<={gap[2]}\\s)" if gap else pattern, replacement, True))
        at += 1
    return out


def normalise(col: Column, pairs: Sequence[tuple[str, str]] = (), repair: bool = True, ascii: bool = True) -> Column:
    """Lower-cased text with all cleaning rules applied."""
    out = F.lower(col)
    for pattern, replacement, is_regex in quick_rules(cleaning_rules(pairs, repair, ascii), ascii):
        out = replace_all(out, [(pattern, replacement)]) if is_regex else F.replace(out, F.lit(pattern), F.lit(replacement))
    return out
