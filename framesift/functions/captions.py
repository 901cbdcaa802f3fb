"""Caption expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Openings that captioning models put before the actual description.
CAPTION_PREFIXES = [
    "The video shows",
    "The video captures",
    "The video features",
    "The video depicts",
    "The video presents",
    "The video is ",
    "In the video,",
    "The image shows",
    "The image captures",
    "The image features",
    "The image depicts",
    "The image presents",
    "The image is ",
    "The image portrays",
    "In the image,",
]

# Camera motion labels and how they read in a caption.
CAMERA_MOTION_WORDS = {
    "static": "static",
    "pan_right": "pan right",
    "pan_left": "pan left",
    "zoom_in": "zoom in",
    "zoom_out": "zoom out",
    "tilt_up": "tilt up",
    "tilt_down": "tilt down",
}

# Whitespace as a Unicode-aware strip sees it.
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim every kind of whitespace at both ends (plain trim only knows the space)."""
    return F.btrim(text, F.lit(WHITESPACE))


def capitalise_first(text: Column) -> Column:
    return F.concat(F.upper(F.left(text, F.lit(1))), F.substring(text, 2, 2**31 - 1))


def strip_caption_prefix(text: Column) -> Column:
    """Drop one listed opening (as listed or lower-cased), then trim and capitalise the rest.

    A caption that is nothing but the opening becomes an empty string.
    """
    options = "|".join(re.escape(p).replace(r"\ ", " ") for q in CAPTION_PREFIXES for p in (q, q.lower()))
    pattern = f"^(?:{options})"
    return F.when(text.rlike(pattern), capitalise_first(strip(F.regexp_replace(text, pattern, "")))).otherwise(text)


def append_text(text: Column, suffix: str) -> Column:
    return F.concat(text, F.lit(suffix))


def merge_camera_motion(text: Column, label: Column, on_unmapped: str = "error") -> Column:
    """Append ``Camera motion: <words>.``; labels may be spelt with a space or an underscore."""
    words = F.create_map(*[F.lit(x) for pair in CAMERA_MOTION_WORDS.items() for x in pair])
    found = F.try_element_at(words, F.replace(label, F.lit(" "), F.lit("_")))
    if on_unmapped == "error":
        other = F.raise_error(F.concat(F.lit("unmapped camera motion: "), F.coalesce(label, F.lit("NULL"))))
    elif on_unmapped == "keep":
        other = text
    else:
        raise ValueError(f"unknown on_unmapped {on_unmapped!r}")
    return F.when(found.isNotNull(), F.concat(text, F.lit(" Camera motion: "), found, F.lit("."))).otherwise(other)


def fixed1(value: Column) -> Column:
    """One decimal place, rounding the exact binary value half to even as C's ``%.1f`` does.

    ``format_string`` rounds the shortest decimal form half up instead and differs on ties. Works in
    integers of 2**-59, which hold any fraction that can reach a tie.
    """
    value = value.cast("double")
    size = F.abs(value)
    whole = F.floor(size).cast("bigint")
    tenths = ((size - whole.cast("double")) * F.lit(float(2**59))).cast("bigint") * F.lit(10)
    digit = F.shiftright(tenths, 59)
    rest = tenths - F.shiftleft(digit, 59)
    half = F.lit(2**58)
    digit = digit + F.when((rest > half) | ((rest == half) & (digit % 2 == 1)), 1).otherwise(0)
    whole = whole + F.when(digit == 10, 1).otherwise(0)
    digit = digit % 10
    sign = F.when(value < 0, "-").otherwise("")
    return F.concat(sign, whole.cast("string"), F.lit("."), digit.cast("string"))


def score_text(score: Column, missing: str = "nan") -> Column:
    return F.when(score.isNull() | F.isnan(score), F.lit(missing)).otherwise(fixed1(score))


def score_to_text(
    text: Column, aes: Column | None, flow: Column | None, draws: tuple[Column, Column], drop: float = 0.2
) -> Column:
    """Append `` [aesthetic score: x, motion score: y]``, leaving a part out when its draw is <= drop."""
    parts = []
    for name, score, draw in (("aesthetic", aes, draws[0]), ("motion", flow, draws[1])):
        if score is not None:
            parts.append(F.when(draw > drop, F.concat(F.lit(f"{name} score: "), score_text(score))))
    if not parts:
        return text
    kept = F.concat_ws(", ", *parts)
    return F.when(kept == "", text).otherwise(F.concat(text, F.lit(" ["), kept, F.lit("]")))


def append_score_to_prompt(
    prompt: Column, aes: Column | None = None, flow: Column | None = None, camera_motion: Column | None = None
) -> Column:
    """Append each score sentence unless the prompt already has one of its kind."""
    out = prompt
    for marker, value in (
        ("aesthetic score:", None if aes is None else score_text(aes)),
        ("motion score:", None if flow is None else score_text(flow)),
        ("camera motion:", camera_motion),
    ):
        if value is not None:
            sentence = F.concat(F.lit(f" {marker} "), value, F.lit("."))
            out = F.when(F.instr(prompt, marker) > 0, out).otherwise(F.concat(out, sentence))
    return out


def light_clean(text: Column) -> Column:
    return strip(F.lower(text))


def whitespace_tokens(text: Column) -> Column:
    """Number of whitespace-separated words: a stand-in count, not a subword tokenizer's."""
    words = strip(text)
    return F.when(words == "", F.lit(0)).otherwise(F.size(F.split(words, f"{_SPACE}+"))).cast("int")


def newline_to_space(text: Column) -> Column:
    return strip(F.replace(text, F.lit("\n"), F.lit(" ")))


NONE_FOUND = "NONE_FOUND"


def parse_bracket_tags(answer: Column, compat: bool = False) -> Column:
    """Text between the first ``[`` and the first ``]``; ``NONE_FOUND`` if blank, broken or absent.

    ``compat`` slices as if a missing bracket sat before the first or at the last character.
    """
    start, end = F.instr(answer, "["), F.instr(answer, "]")
    if compat:
        stop = F.when(end == 0, F.length(answer)).otherwise(end)
        body = F.substring(answer, start + 1, F.greatest(stop - start - 1, F.lit(0)))
    else:
        body = F.when((start > 0) & (end > start), F.substring(answer, start + 1, end - start - 1))
    bad = body.isNull() | (F.instr(body, "\n") > 0) | (F.length(strip(body)) == 0)
    return F.when(bad, F.lit(NONE_FOUND)).otherwise(body)


def render_prompt(template: Column, text: Column, key: Column | None = None) -> Column:
    """Fill ``{}`` and ``{task_description}``; with a key, only templates named ``*text*`` take one."""
    filled = F.replace(F.replace(template, F.lit("{task_description}"), text), F.lit("{}"), text)
    return filled if key is None else F.when(F.instr(key, "text") > 0, filled).otherwise(template)


def tidy_model_answer(answer: Column, role_tag: str, end_tag: str) -> Column:
    """What follows the last role tag, without the closing tag, on one line."""
    tail = F.substring_index(answer, role_tag, -1) if role_tag else answer
    if end_tag:
        tail = F.when(
            F.endswith(tail, F.lit(end_tag)), F.substring(tail, F.lit(1), F.length(tail) - len(end_tag))
        ).otherwise(tail)
    return F.replace(strip(tail), F.lit("\n"), F.lit(" "))
