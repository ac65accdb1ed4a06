"""License scan by a positional rare-token index.

Templates are licence notices. The words of all templates get their inverse document frequency from the whole
corpus; each template's rarest words, with their positions, form the index. A file looks up every occurrence
of an indexed word, and each posting votes for (template, start = position in file - position in template).
Starts with enough different words are aligned word by word with the template, and a template counts only if
one of its mandatory key phrases stands in the aligned stretch.

Besides, base phrases are found wherever their words stand consecutively; their labels always stay.

Defined cases: null and empty texts have no words, no labels, score 0. Repeated rows are scanned each. Ties
between starts go to the smaller one. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.common import ids, map_batches, stream, table, text_bytes

# Fixed values of the result contract: phrase and label.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, notice (in the words the scan sees), mandatory key phrases.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", ["permission is hereby granted free of charge"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "licensed under the mit license", ["mit license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ["with or without fee is hereby granted"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ["redistribution and use in source and binary forms"]),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", ["apache license version 2 0"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["gnu general public license"]),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ["gnu lesser general public license"]),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", ["gnu affero general public license"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", ["mozilla public license v 2 0"]),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", ["eclipse public license 2 0"]),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software", ["unencumbered software released into the public domain"]),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain under the cc0 1 0 universal public domain dedication", ["cc0 1 0"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike 4 0"]),
    ("bsl-1.0", "distributed under the boost software license version 1 0", ["boost software license version 1 0"]),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ["in no event will the authors be held liable"]),
    ("all-rights-reserved", "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by any means", ["no part of this publication may be reproduced"]),
]

RARE_WORDS = 8  # index words per template
SHIFT = 3  # words that may be inserted or missing before an indexed word
AGREE = 0.6  # share of a template's words that must stand in place

LOWER_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
])


def words_of(text: bytes) -> list[bytes]:
    """Words of the contract: runs of digits, letters and bytes beyond ASCII, A-Z in lower case."""
    return text.translate(LOWER_WORDS).split()


def _encoded(phrase: str) -> list[bytes]:
    return phrase.encode().split()


BASE_WORDS = [(_encoded(p), label) for p, label in BASE.items()]
TEMPLATE_WORDS = [(label, _encoded(notice), [_encoded(k) for k in keys]) for label, notice, keys in TEMPLATES]
VOCABULARY = frozenset(w for _, words, _ in TEMPLATE_WORDS for w in words) | {w for ws, _ in BASE_WORDS for w in ws}


def document_frequency(docs: DataFrame) -> tuple[dict[bytes, int], int]:
    """In how many documents each template word occurs, and the number of documents; over all of them.

    Tasks send one row per template word, so the driver gets as many rows as there are template words.
    """
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def count(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in iterator:
            for text in text_bytes(batch):
                seen.update(VOCABULARY.intersection(words_of(text)))
                seen[b""] += 1
        yield pa.RecordBatch.from_pydict({"word": list(seen), "n": list(seen.values())}, schema=schema)

    counted = map_batches(docs.select("text"), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {bytes(r["word"]): r["n"] for r in counted.collect()}
    return found, found.pop(b"", 0)


def rare_token_index(frequency: dict[bytes, int], n_docs: int) -> dict[bytes, list[tuple[int, int]]]:
    """Word -> postings (template, position) for each template's words of highest IDF."""
    idf = {w: math.log((n_docs + 1) / (frequency.get(w, 0) + 1)) for w in VOCABULARY}
    postings = defaultdict(list)
    for number, (_, words, _) in enumerate(TEMPLATE_WORDS):
        rare = set(sorted(set(words), key=lambda w: (-idf[w], w))[:RARE_WORDS])
        for position, word in enumerate(words):
            if word in rare:
                postings[word].append((number, position))
    return dict(postings)


def stands_at(words: list[bytes], start: int, phrase: list[bytes]) -> bool:
    return words[start : start + len(phrase)] == phrase


def in_place(words: list[bytes], start: int, template: list[bytes]) -> int:
    """Template words found in order from `start` on, each at most SHIFT words away from its place."""
    at, found = start, 0
    for word in template:
        near = words[max(at, 0) : max(at, 0) + SHIFT + 1]
        if word in near:
            found += 1
            at = max(at, 0) + near.index(word) + 1
        else:
            at += 1
    return found


def templates_in(words: list[bytes], places: dict[bytes, list[int]], index: dict) -> dict[str, float]:
    """Label -> share of the template in place, for templates that pass the vote, the alignment and a key phrase."""
    votes = defaultdict(set)
    for word, positions in places.items():
        for number, offset in index.get(word, ()):
            for position in positions:
                for shift in range(SHIFT + 1):
                    votes[number, position - offset - shift].add(word)
    found: dict[str, float] = {}
    for (number, start), agreeing in sorted(votes.items()):
        label, template, keys = TEMPLATE_WORDS[number]
        if len(agreeing) < max(2, math.ceil(AGREE * min(RARE_WORDS, len(set(template))))):
            continue
        share = in_place(words, start, template) / len(template)
        low, high = max(start - SHIFT, 0), start + len(template) + SHIFT * 2
        verified = any(stands_at(words, i, key) for key in keys for i in range(low, min(high, len(words))))
        if verified and share >= max(AGREE, found.get(label, 0.0)):
            found[label] = share
    return found


def scan(text: bytes, index: dict) -> tuple:
    words = words_of(text)
    places = defaultdict(list)
    for i, word in enumerate(words):
        if word in VOCABULARY:
            places[word].append(i)
    starts, base = [], set()
    for phrase, label in BASE_WORDS:
        hits = [i for i in places.get(phrase[0], ()) if stands_at(words, i, phrase)]
        if hits:
            starts += hits
            base.add(label)
    found = templates_in(words, places, index) if places else {}
    score = max([0.0, *([1.0] if base else []), *found.values()])
    labels = ",".join(sorted(base | set(found)))
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), labels, score)


def _scan_batch(batch: pa.RecordBatch, index: dict) -> dict[str, list]:
    rows = [scan(text, index) for text in text_bytes(batch)]
    return dict(zip(ARROW.names, [ids(batch), *map(list, zip(*rows, strict=True))], strict=True))


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: word counts, base places, labels of base phrases and templates, best score."""
    index = rare_token_index(*document_frequency(docs))
    one = partial(_scan_batch, index=index)
    return map_batches(docs.select("doc_id", "text"), partial(stream, one=one, schema=ARROW), SCHEMA)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
