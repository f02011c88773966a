"""License scans by sentence rules.

The sentences of a text are normalised (lower case, letters and digits only) and
those that speak of licensing are mapped to identifiers of known sentences, in order
of position: a sentence that names two licences has both. The more specific phrase
takes its words first. The sequence of identifiers is then matched against licence
rules, in order, longer rules before the shorter ones they contain; what a rule has
matched is used up. Everything is row-local, in built-in functions: no text is shuffled,
and a text without a licence word is not split at all.

Defined results
- A null or empty text, or one without licence words, has no sentences and no licence.
- Licence-like sentences in which nothing is known get the identifier ``unknown``. They
  are counted, and interrupt a sequence.
- A line that begins a licence notice begins a sentence, whatever stands before it.
- The identifiers of an SPDX line are those of its expression, joined by AND or OR.
- A licence found several times is named once. Licences are named in order of the rules.
- Repeated rows have a row each; an empty table gives no rows.
- A text of any length is scanned whole by one task. Other columns stay in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values. A sentence with one of these stems speaks of licensing; so does every
# sentence that one of SENTENCES fits.
LICENCE_WORDS = (
    r"licen[sc]|copyright|copyleft|permission|warrant|redistribut|public domain"
    r"|free software|all rights reserved|creative commons|\bcc by\b|\bcc0\b"
    r"|to endorse|\bas is\b|be liable|gpl|bsd [23] clause|cc zero|advertising materials"
    r"|attribution (non ?commercial|no ?deriv|share ?alike)|unless required by applicable law|unencumbered software"
    r"|under (the )?(terms of the )?mit\b"
)


def _within(words: int) -> str:
    """Up to so many words, as few as will do. What is used up already is no word."""
    return rf"(?: [a-z0-9]+){{0,{words}}}?"


def _version(name: str, number: str) -> str:
    """A licence with its version after the name, or before it."""
    return rf"({name}){_within(12)} (version |v ?)?{number}\b|(version |v ?){number} of the (gnu )?({name})"


_GPL, _LGPL, _AGPL = (r"general public licen[sc]e|\bgpl", r"lesser general public licen[sc]e|\blgpl", r"affero general public licen[sc]e|\bagpl")


def _later(number: str) -> str:
    later = rf"{_within(10)} later( version)?"
    return rf"({_GPL}){_within(12)} (version |v)?{number}{later}|(version |v){number}{later} of the (gnu )?({_GPL})"


# Fixed values. Known sentences, as patterns on the normalised sentence; the first ones take
# their words first.
SENTENCES = (
    ("apache2-ref", r"apache licen[sc]e version 2( 0)?\b|apache 2( 0)? licen[sc]e|version 2( 0)? of the apache licen[sc]e"),
    ("apache-comply", r"may not use this file except in compliance with the licen[sc]e"),
    ("apache-copy", r"may obtain a copy of the licen[sc]e at"),
    ("apache-warranty", r"unless required by applicable law or agreed to in writing"),
    ("apache-limits", r"see the licen[sc]e for the specific language governing"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit-notice", r"copyright notice and this permission notice shall be included in all copies"),
    ("mit-ref", r"\bmit licen[sc]e|under (the )?(terms of the )?mit\b"),
    ("isc-grant", r"permission to use copy modify and or distribute this software for any purpose"),
    ("isc-ref", r"\bisc licen[sc]e"),
    ("bsd-grant", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd-source", r"redistributions of source code must retain"),
    ("bsd-binary", r"redistributions in binary form must reproduce"),
    ("bsd-name", rf"neither the name of{_within(40)} may be used to endorse"),
    ("bsd-advert", r"all advertising materials mentioning features"),
    ("bsd3-ref", r"(3 clause|three clause|new|modified|revised) bsd licen[sc]e|bsd 3 clause"),
    ("bsd2-ref", r"(2 clause|two clause|simplified|freebsd) (bsd )?licen[sc]e|bsd 2 clause"),
    ("bsd-ref", r"\bbsd( style)? licen[sc]e"),
    ("agpl3-ref", _version(_AGPL, "3( 0)?")),
    ("lgpl3-ref", _version(_LGPL, "3( 0)?")),
    ("lgpl21-ref", _version(_LGPL, "2 1")),
    ("lgpl2-ref", _version(r"(library|lesser) general public licen[sc]e|\blgpl", "2( 0)?")),
    ("gpl3-later", _later("3( 0)?")),
    ("gpl2-later", _later("2( 0)?")),
    ("gpl3-ref", _version(_GPL, "3( 0)?") + r"|\bgplv3\b"),
    ("gpl2-ref", _version(_GPL, "2( 0)?") + r"|\bgplv2\b"),
    ("gpl-ref", r"general public licen[sc]e|\bgpl\b"),
    ("mpl2-ref", _version(r"mozilla public licen[sc]e", "2( 0)?")),
    ("epl2-ref", _version(r"eclipse public licen[sc]e", "2( 0)?")),
    ("cc-by-nc-nd", r"\bcc by nc nd\b|attribution non ?commercial no ?deriv"),
    ("cc-by-nc-sa", r"\bcc by nc sa\b|attribution non ?commercial share ?alike"),
    ("cc-by-nc", r"\bcc by nc\b|attribution non ?commercial"),
    ("cc-by-nd", r"\bcc by nd\b|attribution no ?deriv"),
    ("cc-by-sa", r"\bcc by sa\b|attribution share ?alike"),
    ("cc0", r"\bcc0\b|cc zero"),
    ("cc-by", r"\bcc by\b|creative commons attribution"),
    ("unlicense", r"free and unencumbered software released into|\bthe unlicense\b"),
    ("public-domain", r"(in|into|to) the public domain"),
    ("rights-reserved", r"all rights reserved"),
    ("as-is", rf"provided (by{_within(20)} )?as is"),
    ("liability", rf"in no event shall{_within(30)} be liable"),
    ("copyright", r"^(portions )?copyright\b"),
)
# Fixed values. Identifiers of an SPDX expression, which has no words around them.
SPDX = "spdx license identifier"
SPDX_NAMES = (
    ("apache2-ref", r"\bapache 2 0\b"),
    ("mit-ref", r"\bmit\b"),
    ("isc-ref", r"\bisc\b"),
    ("bsd3-ref", r"\bbsd 3 clause\b"),
    ("bsd2-ref", r"\bbsd 2 clause\b"),
    ("agpl3-ref", r"\bagpl 3 0( only| or later)?\b"),
    ("lgpl3-ref", r"\blgpl 3 0( only| or later)?\b"),
    ("lgpl21-ref", r"\blgpl 2 1( only| or later)?\b"),
    ("lgpl2-ref", r"\blgpl 2 0( only| or later)?\b"),
    ("gpl3-later", r"\bgpl 3 0 or later\b"),
    ("gpl2-later", r"\bgpl 2 0 or later\b"),
    ("gpl3-ref", r"\bgpl 3 0( only)?\b"),
    ("gpl2-ref", r"\bgpl 2 0( only)?\b"),
    ("mpl2-ref", r"\bmpl 2 0\b"),
    ("epl2-ref", r"\bepl 2 0\b"),
    ("cc-by-nc-nd", r"\bcc by nc nd( [0-9]+)*\b"),
    ("cc-by-nc-sa", r"\bcc by nc sa( [0-9]+)*\b"),
    ("cc-by-nc", r"\bcc by nc( [0-9]+)*\b"),
    ("cc-by-nd", r"\bcc by nd( [0-9]+)*\b"),
    ("cc-by-sa", r"\bcc by sa( [0-9]+)*\b"),
    ("cc0", r"\bcc0( [0-9]+)*\b"),
    ("cc-by", r"\bcc by( [0-9]+)*\b"),
    ("unlicense", r"\bunlicense\b"),
)
# Fixed values. Licences by sequences of identifiers, in the order of matching.
RULES = (
    ("Apache-2.0", "apache2-ref apache-comply apache-copy apache-warranty apache-limits"),
    ("Apache-2.0", "apache2-ref apache-comply apache-copy apache-warranty"),
    ("Apache-2.0", "apache2-ref"),
    ("MIT", "mit-grant mit-notice as-is liability"),
    ("MIT", "mit-grant mit-notice as-is"),
    ("MIT", "mit-grant mit-notice"),
    ("MIT", "mit-ref"),
    ("ISC", "isc-grant as-is liability"),
    ("ISC", "isc-grant"),
    ("ISC", "isc-ref"),
    ("BSD-4-Clause", "bsd-grant bsd-source bsd-binary bsd-advert bsd-name"),
    ("BSD-3-Clause", "bsd-grant bsd-source bsd-binary bsd-name"),
    ("BSD-2-Clause", "bsd-grant bsd-source bsd-binary"),
    ("BSD-3-Clause", "bsd3-ref"),
    ("BSD-2-Clause", "bsd2-ref"),
    ("BSD", "bsd-ref"),
    ("AGPL-3.0", "agpl3-ref"),
    ("LGPL-3.0", "lgpl3-ref"),
    ("LGPL-2.1", "lgpl21-ref"),
    ("LGPL-2.0", "lgpl2-ref"),
    ("GPL-3.0-or-later", "gpl3-later"),
    ("GPL-2.0-or-later", "gpl2-later"),
    ("GPL-3.0", "gpl3-ref"),
    ("GPL-2.0", "gpl2-ref"),
    ("GPL", "gpl-ref"),
    ("MPL-2.0", "mpl2-ref"),
    ("EPL-2.0", "epl2-ref"),
    ("CC-BY-NC-ND", "cc-by-nc-nd"),
    ("CC-BY-NC-SA", "cc-by-nc-sa"),
    ("CC-BY-NC", "cc-by-nc"),
    ("CC-BY-ND", "cc-by-nd"),
    ("CC-BY-SA", "cc-by-sa"),
    ("CC0-1.0", "cc0"),
    ("CC-BY", "cc-by"),
    ("Unlicense", "unlicense"),
    ("Public-Domain", "public-domain"),
    ("All-Rights-Reserved", "copyright rights-reserved"),
    ("All-Rights-Reserved", "rights-reserved"),
)
UNKNOWN = "unknown"
# A sentence ends at punctuation before white space or the end, or at an empty line.
SENTENCE_END = r"[.!?;:]+([\x20\x09-\x0D]+|$)|\n[\x20\x09-\x0D]*\n"
# Lines that begin a notice are set apart; an SPDX tag loses its colon, a version's "v." its stop.
NOTICE = (
    r"(?i)\n([\x20\x09]*(?:[#*/-]+[\x20\x09]*)?(?:spdx-license-identifier"
    r"|(?:dual[ -])?(?:released|licen[sc]ed|distributed|available) under"
    r"|this [a-z]+ is (?:dual[ -])?(?:released|licen[sc]ed|distributed|available) under))"
)
SPDX_TAG = r"(?i)spdx-license-identifier:"
VERSION_STOP = r"(?i)\bv\.[\x20\x09]*([0-9])"
NOT_A_WORD = r"[^\p{L}\p{N}]+"
# A known phrase is replaced by its number between marks, which are no part of a word.
MARK = r"#([0-9]+)#"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), NOT_A_WORD, " "))


def sentence_ids(text: Column) -> Column:
    """Identifiers of the licence-like sentences of a text, in order."""
    numbers = {name: i for i, (name, _) in enumerate(SENTENCES, 1)}
    names = F.array(*[F.lit(name) for name in numbers])

    def marked(sentence: Column, patterns: tuple[tuple[str, str], ...]) -> Column:
        for name, pattern in patterns:
            sentence = F.regexp_replace(sentence, pattern, f" #{numbers[name]}# ")
        return F.regexp_extract_all(sentence, F.lit(MARK), F.lit(1))

    def identify(sentence: Column) -> Column:
        found = F.when(sentence.startswith(SPDX), marked(sentence, SPDX_NAMES)).otherwise(marked(sentence, SENTENCES))
        known = F.transform(found, lambda number: F.element_at(names, number.cast("int")))
        return F.when(F.size(known) > 0, known).otherwise(F.array(F.lit(UNKNOWN)))

    plain = F.regexp_replace(F.regexp_replace(text, NOTICE, "\n\n$1"), SPDX_TAG, f"{SPDX} ")
    plain = F.regexp_replace(plain, VERSION_STOP, "v $1")
    sentences = F.transform(F.split(plain, SENTENCE_END), normalised)
    known = F.flatten(F.transform(F.filter(sentences, lambda x: x.rlike(LICENCE_WORDS)), identify))
    speaks = F.lower(F.regexp_replace(text, NOT_A_WORD, " ")).rlike(LICENCE_WORDS)
    return F.when(speaks, known).otherwise(F.array().cast("array<string>"))


def licences_of(ids: Column) -> Column:
    """Names of the licences whose sequences stand in ``ids``."""
    nothing = F.array().cast("array<string>")
    rules = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(f" {sequence.replace(' ', '  ')} ").alias("part"))
            for name, sequence in RULES
        ]
    )
    start = F.struct(
        F.concat(F.lit(" "), F.array_join(ids, "  "), F.lit(" ")).alias("rest"), nothing.alias("names")
    )

    def use(acc: Column, rule: Column) -> Column:
        # What a rule has matched is replaced by a mark, which interrupts sequences too.
        used = F.struct(
            F.replace(acc["rest"], rule["part"], F.lit(" + ")).alias("rest"),
            F.array_append(acc["names"], rule["name"]).alias("names"),
        )
        return F.when(F.contains(acc["rest"], rule["part"]), used).otherwise(acc)

    matched = F.aggregate(rules, start, use, lambda acc: F.array_distinct(acc["names"]))
    return F.when(F.size(ids) > 0, matched).otherwise(nothing)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row as struct ``row``, with sentences, licenses and n_unknown.

    ``sentences`` and ``licenses`` are texts, joined by commas.
    """
    found = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        sentence_ids(F.coalesce(F.col(text_col), F.lit(""))).alias("ids"),
    )
    return found.select(
        "row",
        F.array_join("ids", ",").alias("sentences"),
        F.array_join(licences_of(F.col("ids")), ",").alias("licenses"),
        F.size(F.filter("ids", lambda x: x == UNKNOWN)).cast("bigint").alias("n_unknown"),
    )
