"""Text expressions. All of them run inside the JVM.

An expression that needs the same intermediate text several times takes that
text as its argument. The table operators compute it in a projection of its
own first, so it is evaluated once per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanclean.values import NOTE_TYPOS, WHITESPACE

# A character outside printable ASCII. Texts without one have no white space but blanks.
_UNUSUAL = "[^ -~]"

# Non-decimal characters that Python's str.isdigit() accepts: superscripts,
# subscripts, circled and other numbered forms (Unicode property "Digit").
_OTHER_DIGITS = (
    r"\u00b2\u00b3\u00b9\u1369-\u1371\u19da\u2070\u2074-\u2079\u2080-\u2089"
    r"\u2460-\u2468\u2474-\u247c\u2488-\u2490\u24ea\u24f5-\u24fd\u24ff"
    r"\u2776-\u277e\u2780-\u2788\u278a-\u2792\x{10A40}-\x{10A43}"
    r"\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)
NOT_A_DIGIT = rf"[^\p{{Nd}}{_OTHER_DIGITS}]"


def strip(col: Column) -> Column:
    """Remove leading and trailing white space of every kind.

    Trimming blanks is far cheaper than trimming a set of characters, and it is
    enough for plain ASCII text.
    """
    return F.when(col.rlike(_UNUSUAL), F.btrim(col, F.lit(WHITESPACE))).otherwise(F.trim(col))


def blanks(col: Column) -> Column:
    """Replace every white-space character by a plain blank."""
    return F.when(col.rlike(_UNUSUAL), F.translate(col, WHITESPACE, " " * len(WHITESPACE))).otherwise(col)


def squeeze(col: Column) -> Column:
    """Strip, and shrink each inner run of white space to one blank."""
    return F.btrim(F.regexp_replace(blanks(col), " +", " "))


def null_if_in(col: Column, markers: list[str]) -> Column:
    """Null where the whole untrimmed cell equals one of the markers."""
    return F.when(~col.isin(markers), col)


def last_word_upper(col: Column) -> Column:
    """Last white-space separated word in upper case; null when there is none."""
    word = F.substring_index(F.btrim(blanks(col)), " ", -1)
    return F.nullif(F.upper(word), F.lit(""))


def digits(col: Column) -> Column:
    return F.regexp_replace(col, NOT_A_DIGIT, "")


def phone_layout(ten: Column) -> Column:
    """``ddd-ddd-dddd`` for a text of exactly ten digits, else null."""
    return F.when(
        F.length(ten) == 10,
        F.concat_ws("-", F.substring(ten, 1, 3), F.substring(ten, 4, 3), F.substring(ten, 7, 4)),
    )


def sentence_case(col: Column) -> Column:
    low = F.lower(col)
    return F.concat(F.upper(F.substring(low, 1, 1)), low.substr(F.lit(2), F.length(low)))


def repair_note(note: Column, typos: list[tuple[str, str]] = NOTE_TYPOS) -> Column:
    """Undo all-capitals text and put known misspellings right in any case, in a squeezed note."""
    note = F.when((note == F.upper(note)) & (note != F.lower(note)), sentence_case(note)).otherwise(note)
    fixed = note
    for right, wrong in typos:
        begun = F.replace(fixed, F.lit(wrong.capitalize()), F.lit(right.capitalize()))
        fixed = F.regexp_replace(begun, f"(?i){wrong}", right)
    # a note without a misspelling is searched once
    return F.when(note.rlike("(?i)" + "|".join(wrong for _, wrong in typos)), fixed).otherwise(note) if typos else note


def note_words(col: Column) -> Column:
    """Distinct lower-case words of a note, without digits and punctuation."""
    return F.array_distinct(F.regexp_extract_all(F.lower(col), F.lit(r"(\p{L}+)"), 1))
