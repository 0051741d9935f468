"""Licence recognition by sentence rules.

Texts are cut into sentences and normalised; known licence sentences have identifiers. The
identifiers of a text in their order are matched against licence rules, which are sequences
of them. A longer rule comes first and covers the shorter ones inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Sentences of public licences and licence notices, normalised.
SENTENCES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-notice": "released under the mit license",
    "mit-notice-2": "this project is licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-include": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-notice": "licensed under cc by 4 0",
    "cc-by-sa-notice": "licensed under cc by sa 4 0",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
}
#: (rule, licence, identifiers in order); a rule stands before those whose sequence it contains.
RULES = [
    ("apache-header", "Apache-2.0", ["apache-notice", "apache-use", "apache-copy", "apache-basis", "apache-see"]),
    ("mit-text", "MIT", ["mit-grant", "mit-include", "mit-warranty"]),
    ("gpl3-header", "GPL-3.0", ["gpl-free", "gpl-hope", "gpl-copy"]),
    ("bsd3-text", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("bsd2-text", "BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("apache-notice", "Apache-2.0", ["apache-notice"]),
    ("mit-notice", "MIT", ["mit-notice"]),
    ("mit-notice-2", "MIT", ["mit-notice-2"]),
    ("gpl3-notice", "GPL-3.0", ["gpl3-notice"]),
    ("cc-by-nc-notice", "CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("cc-by-sa-notice", "CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("cc-by-notice", "CC-BY-4.0", ["cc-by-notice"]),
]

#: One sentence of a canonical text that says what several known sentences say.
TOGETHER = {"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": ["apache-notice", "apache-use"]}
#: A known sentence of so many words counts wherever its words stand; a shorter one must begin and end with a line or sentence.
LONG = 12


def sentences(text: Column) -> Column:
    """Sentences, in order: cut at line ends and after . ! or ? before white space; letters and digits in ASCII lower case."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?])[\x20\x09-\x0D]+", "$1\n"), "\n")
    return F.transform(lines, lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))


def identifiers(cut: Column, known: dict[str, str]) -> Column:
    """The identifiers of the known sentences in normalised ``cut`` ones, in order; a known sentence may run over several lines."""
    phrases = {text: [name] for name, text in known.items()} | {t: ids for t, ids in TOGETHER.items() if all(i in known for i in ids)}
    joined = F.concat(F.lit("|"), F.array_join(cut, "|"), F.lit("|"))
    left, likely = set(phrases), F.lit(False)  # few words, one of which every known sentence has
    while left:
        word = max(sorted({w for p in left for w in p.split()}), key=lambda w: (sum(w in p for p in left) * (len(w) > 4), len(w)))
        likely = likely | F.contains(joined, F.lit(word))
        left = {p for p in left if word not in p}
    marked = joined
    for phrase in sorted(phrases, key=lambda p: (-len(p), p)):
        words = phrase.split()
        edge = "[ |]" if len(words) >= LONG else "[|]"
        marked = F.regexp_replace(marked, f"(?<={edge}){'[ |]'.join(words)}(?={edge})", "|" + "".join(f"#{i}|" for i in phrases[phrase]))
    return F.regexp_extract_all(F.when(likely, marked).otherwise(F.lit("")), F.lit("#([^|]+)"), F.lit(1))


def recognise(docs: DataFrame, text: str = "text", keep: list[str] = ("doc_id",), known: dict[str, str] | None = None, rules=None) -> DataFrame:
    """``keep``, ``n_sentences``, ``sentence_ids`` in order, ``rules`` matched and ``licenses`` of every whole text.

    A sentence counts if it is not empty once normalised. Known sentences are found over line ends, blank lines and
    comment leaders too, see ``LONG``. Identifiers must follow each other
    without another identifier between; unknown sentences may stand there. Rules are tried in
    order, and what one has matched is closed to those after it. ``licenses`` are sorted and distinct. A null or empty text
    has none. No row needs another, so there is no shuffle; the rules are small fixed data.
    """
    known, rules = known or SENTENCES, rules or RULES
    found = docs.select(*keep, F.filter(sentences(F.col(text)), lambda s: s != "").alias("_sentences"))
    ids = identifiers(F.col("_sentences"), known)
    found = found.select(*keep, F.size("_sentences").cast("long").alias("n_sentences"), ids.alias("sentence_ids"))
    left = F.concat(F.lit(";"), F.array_join(F.transform("sentence_ids", lambda i: F.concat(i, F.lit(";"))), ";"))
    found = found.withColumn("_left", left)
    hits = []
    for number, (name, _, sequence) in enumerate(rules):
        pattern = "".join(f";{i};" for i in sequence)
        found = found.withColumn(f"_hit{number}", F.contains(F.col("_left"), F.lit(pattern)))
        found = found.withColumn("_left", F.replace(F.col("_left"), F.lit(pattern), F.lit(";#;")))
        hits.append(F.when(F.col(f"_hit{number}"), F.lit(number)))
    numbers = F.array_compact(F.array(*hits))
    name = F.array(*[F.lit(r[0]) for r in rules])
    licence = F.array(*[F.lit(r[1]) for r in rules])
    return found.select(
        *keep,
        "n_sentences",
        "sentence_ids",
        F.transform(numbers, lambda i: F.get(name, i)).alias("rules"),
        F.array_sort(F.array_distinct(F.transform(numbers, lambda i: F.get(licence, i)))).alias("licenses"),
    )
