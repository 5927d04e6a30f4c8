"""Noise patterns and the text-cleaning column expressions built from them.

The registry is data; ``strip_noise`` folds it into one column expression, so a text
is cleaned inside a single projection of the plan.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Noise categories and patterns, in the order they are applied.
NOISE_PATTERNS: dict[str, tuple[str, ...]] = {
    "email_headers": (
        r"(from :)|(subject :)|(sent :)|(r\s*:)|(re\s*:)",
    ),
    "months": (
        r"(january|february|march|april|may|june|july|august|september|october|november|december)",
        r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)",
    ),
    "days": (
        r"(monday|tuesday|wednesday|thursday|friday|saturday|sunday)",
    ),
    "times": (
        r"\d{2}(:|.)\d{2}",
    ),
    "emails": (
        r"(xxxxx@xxxx\.com)|(\*{5}\([a-z]+\))",
    ),
    "greetings": (
        r"dear ((customer)|(user))",
        r"dear",
        r"(hello)|(hallo)|(hi )|(hi there)",
        r"good morning",
    ),
    "thanks": (
        r"thank you for your patience ((during (our)? investigation)|(and cooperation))?",
        r"thank you for contacting us",
        r"thank you for your availability",
        r"thank you for providing us this information",
        r"thank you for contacting",
        r"thank you for reaching us (back)?",
        r"thank you for patience",
        r"thank you for (your)? reply",
        r"thank you for (your)? response",
        r"thank you for (your)? cooperation",
        r"thank you for providing us with more information",
        r"thank you very kindly",
        r"thank you( very much)?",
    ),
    "follow_up": (
        r"i would like to follow up on the case you raised on the date",
        r"i will do my very best to assist you",
        r"in order to give you the best solution",
        r"could you please clarify your request with following information:",
        r"in this matter",
        r"we hope you(( are)|('re)) doing ((fine)|(well))",
        r"i would like to follow up on the case you raised on",
    ),
    "company_info": (
        r"we apologize for the inconvenience",
        r"sent from my huawei (cell )?phone",
        r"original message",
        r"customer support team",
        r"(aspiegel )?se is a company incorporated under the laws of ireland with its headquarters in dublin, ireland.",
        r"(aspiegel )?se is the provider of huawei mobile services to huawei and honor device owners in",
        r"canada, australia, new zealand and other countries",
    ),
    "numbers": (
        r"\d+",
    ),
    "special_chars": (
        r"[^0-9a-zA-Z]+",
    ),
    "single_chars": (
        r"(\s|^).(\s|$)",
    ),
    "ticket_noise": (
        r"(sv\s*:)|(wg\s*:)|(ynt\s*:)|(fw(d)?\s*:)|(r\s*:)|(re\s*:)|(\[|\])"
        r"|(aspiegel support issue submit)|(null)|(nan)|((bonus place my )?support.pt 自动回复:)",
    ),
}

SUMMARY_ONLY = "ticket_noise"

_ALNUM = string.digits + string.ascii_letters

#: Patterns that find the same matches with fewer steps where they are replaced by a space: alternatives are told apart by
#: their first letters, groups capture nothing, and a run that is one space already is no match.
FASTER = {
    NOISE_PATTERNS["email_headers"][0]: r"(?=[fsr])(?:from :|subject :|sent :|re?\s*:)",
    NOISE_PATTERNS["months"][0]: r"(?=[jfmasond])(?:j(?:anuary|une|uly)|february|ma(?:rch|y)|a(?:pril|ugust)|september|october|november|december)",
    NOISE_PATTERNS["months"][1]: r"(?=[jfmasond])(?:j(?:an|un|ul)|feb|ma[ry]|a(?:pr|ug)|sep|oct|nov|dec)",
    NOISE_PATTERNS["days"][0]: r"(?=[mtwfs])(?:monday|t(?:uesday|hursday)|wednesday|friday|s(?:aturday|unday))",
    NOISE_PATTERNS["times"][0]: r"\d{2}.\d{2}",
    NOISE_PATTERNS["greetings"][2]: r"h(?:ello|allo|i )",
    NOISE_PATTERNS["emails"][0]: r"(?=[x*])(?:xxxxx@xxxx\.com|\*{5}\([a-z]+\))",
    NOISE_PATTERNS["special_chars"][0]: f"[^{_ALNUM} ][^{_ALNUM}]*+| [^{_ALNUM}]++",  # letters one by one: Java looks those up in a table
    NOISE_PATTERNS["single_chars"][0]: r"(?:\s|^).(?:\s|$)",
    NOISE_PATTERNS["ticket_noise"][0]: r"(?=[swyfr\[\]anb])(?:" + NOISE_PATTERNS["ticket_noise"][0].replace("(", "(?:") + ")",
}

# Python's whitespace class also holds the four separators x1c-x1f; Java's does not. A run of one space stays as it is.
_SPACE_RUN = r"(?U)[\s\x{1c}-\x{1f}&&[^ ]][\s\x{1c}-\x{1f}]*| [\s\x{1c}-\x{1f}]+"


class NoiseRegistry:
    """An immutable, ordered set of noise categories."""

    def __init__(self, patterns: dict[str, tuple[str, ...]] | None = None):
        self._patterns = {k: tuple(v) for k, v in (NOISE_PATTERNS if patterns is None else patterns).items()}

    @property
    def categories(self) -> tuple[str, ...]:
        return tuple(self._patterns)

    def patterns(self, category: str) -> tuple[str, ...]:
        return self._patterns[category]

    def with_pattern(self, category: str, pattern: str) -> "NoiseRegistry":
        """A copy with one more pattern; a new category is applied last."""
        re.compile(pattern)
        grown = dict(self._patterns)
        grown[category] = grown.get(category, ()) + (pattern,)
        return NoiseRegistry(grown)

    def summary_patterns(self) -> tuple[str, ...]:
        return self._patterns.get(SUMMARY_ONLY, ())

    def interaction_patterns(self) -> tuple[str, ...]:
        return tuple(p for name, group in self._patterns.items() if name != SUMMARY_ONLY for p in group)


def fused_registry() -> NoiseRegistry:
    """The older script's registry: two pairs of follow-up phrases run together.

    The fused phrases only match when both halves stand side by side.
    """
    follow_up = NOISE_PATTERNS["follow_up"]
    fused = (
        follow_up[0],
        follow_up[1] + follow_up[2],
        follow_up[3] + follow_up[4],
        follow_up[5],
        follow_up[6],
    )
    return NoiseRegistry({**NOISE_PATTERNS, "follow_up": fused})


def java_pattern(pattern: str) -> str:
    """Flags that make a Python pattern mean the same in Java.

    Unicode classes are slower, so only patterns with a class or a dot get the flags. Known patterns are given in their
    :data:`FASTER` form.
    """
    pattern = FASTER.get(pattern, pattern)
    if re.search(r"\\[sdwb]", pattern, re.IGNORECASE):
        return "(?dU)" + pattern
    return "(?d)" + pattern if "." in pattern else pattern


def needed(pattern: str) -> str:
    """The longest plain text outside groups that every match holds, or ``''`` where none of four letters is sure."""
    if any(mark in pattern for mark in ("\\", "[", "{", "(?")):
        return ""
    while (plain := re.sub(r"\([^()]*\)[?*+]?", "\0", pattern)) != pattern:
        pattern = plain
    runs = re.findall(r"[a-z ,:']{4,}", re.sub(r".[?*+]", "\0", pattern))
    return max(runs, key=len, default="") if "|" not in pattern else ""


def replaced(text: Column, pattern: str) -> Column:
    """``text`` with a space for every match; one that lacks what a match holds is not searched."""
    find, held = java_pattern(pattern), needed(pattern)
    if not held:
        return F.regexp_replace(text, find, " ")
    return F.transform(F.array(text), lambda t: F.when(t.contains(held), F.regexp_replace(t, find, " ")).otherwise(t))[0]


def squeeze(text: Column) -> Column:
    """Whitespace runs to one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, _SPACE_RUN, " "))


def strip_noise(text: Column, patterns: tuple[str, ...], lowercase: bool = True) -> Column:
    """Fold the patterns over the text as one nested expression; null gives ``''``."""
    out = F.lower(text) if lowercase else text
    for pattern in patterns:
        out = replaced(out, pattern)
    return F.coalesce(squeeze(out), F.lit(""))
