import duckdb

from tests import oracle
from tidewire.llm import licenses, sql

MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files. The above copyright notice
and this permission notice shall be included in all copies. THE SOFTWARE IS
PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND. IN NO EVENT SHALL THE AUTHORS BE LIABLE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are
permitted. Redistributions of source code must retain the above copyright notice. Redistributions in
binary form must reproduce it. {}THIS SOFTWARE IS PROVIDED BY THE AUTHORS "AS IS"."""
NAME = "Neither the name of the owner nor others may be used to endorse products. "


def scan(documents, *texts):
    docs = documents(*[(i, text, "en") for i, text in enumerate(texts)])
    docs = docs.withColumnRenamed("source", "licenses").withColumnRenamed("n_chars", "ids")
    rows = licenses.scan(docs).select("row.doc_id", "sentences", "licenses", "n_unknown").collect()
    return [tuple(row)[1:] for row in sorted(rows)]


def test_texts(documents):
    got = scan(
        documents,
        MIT,
        BSD.format(""),
        BSD.format(NAME),
        "Some text.\nLicensed under the Apache License, Version 2.0.\nMore text.",
        "No end here\nReleased under the MIT License.\n\nLicensed under CC BY-NC 4.0.",
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU General Public License version 2, or (at your option) any later version.",
        "Used by permission of the owner. Some licence of our own.",
    )
    assert [licence for _, licence, _ in got] == [
        "MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MIT,CC-BY-NC", "GPL-3.0", "GPL-2.0-or-later", "",
    ]
    assert got[0][0] == "mit-ref,copyright,mit-grant,mit-notice,as-is,liability"
    assert got[7] == ("unknown,unknown", "", 2)


def test_order_counts(documents):
    in_order = "Redistributions of source code must retain this. Redistributions in binary form must reproduce it."
    assert scan(documents, in_order)[0] == ("bsd-source,bsd-binary", "", 0)
    turned = "Redistributions in binary form must reproduce it. Redistribution and use in source and binary forms, with or without modification."
    assert scan(documents, turned)[0][1] == ""


def test_edge_rows(documents, spark):
    nothing = ("", "", 0)
    long_text = "word " * 100_000 + "Released under the MIT License."
    got = scan(documents, None, "", "plain text.", "MIT License. MIT license!", long_text, long_text)
    assert got == [nothing, nothing, nothing, ("mit-ref,mit-ref", "MIT", 0), *[("mit-ref", "MIT", 0)] * 2]
    assert licenses.scan(documents((1, "x", "en")).limit(0)).count() == 0


def test_every_rule_uses_known_sentences():
    names = {name for name, _ in licenses.SENTENCES}
    for _, sequence in licenses.RULES:
        assert set(sequence.split()) <= names


SAMPLES = {
    "apache2-ref": "Under the Apache License, Version 2.0",
    "apache-comply": "You may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at this place",
    "apache-warranty": "Unless required by applicable law or agreed to in writing, it comes as found",
    "apache-limits": "See the License for the specific language governing limits",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies",
    "mit-ref": "Released under the MIT License",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose is granted",
    "isc-ref": "Under the ISC license",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "bsd-source": "Redistributions of source code must retain this",
    "bsd-binary": "Redistributions in binary form must reproduce this",
    "bsd-name": "Neither the name of the owner nor others may be used to endorse products",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display the following",
    "bsd3-ref": "Distributed under the BSD 3-Clause terms",
    "bsd2-ref": "Distributed under the BSD 2-Clause terms",
    "bsd-ref": "Under a BSD-style license",
    "agpl3-ref": "Released under the AGPL v3",
    "lgpl3-ref": "Released under the LGPL v3",
    "lgpl21-ref": "Released under the LGPL v2.1",
    "lgpl2-ref": "GNU Library General Public License, version 2",
    "gpl3-later": "GNU General Public License, version 3, or any later version",
    "gpl2-later": "GNU General Public License, version 2, or any later version",
    "gpl3-ref": "Released under the GPL, version 3",
    "gpl2-ref": "Released under the GPL, version 2",
    "gpl-ref": "Released under the GPL",
    "mpl2-ref": "Mozilla Public License 2.0",
    "epl2-ref": "Eclipse Public License 2.0",
    "cc-by-nc-nd": "Attribution-NonCommercial-NoDerivatives 4.0 International",
    "cc-by-nc-sa": "Attribution-NonCommercial-ShareAlike 4.0 International",
    "cc-by-nc": "Attribution-NonCommercial 4.0 International",
    "cc-by-nd": "Attribution-NoDerivatives 4.0 International",
    "cc-by-sa": "Attribution-ShareAlike 4.0 International",
    "cc0": "Given away as CC Zero",
    "cc-by": "Creative Commons Attribution 4.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "public-domain": "We place it in the public domain",
    "rights-reserved": "All rights reserved",
    "as-is": "It is provided as is",
    "liability": "In no event shall the authors be liable",
    "copyright": "Copyright 2020 Someone",
}


def test_every_known_sentence_and_rule_is_reached(documents):
    assert set(SAMPLES) == set(dict(licenses.SENTENCES))
    got = scan(documents, *[f"{text}." for text in SAMPLES.values()])
    assert [sentences for sentences, _, _ in got] == list(SAMPLES)
    texts = [". ".join(SAMPLES[name] for name in sequence.split()) + "." for _, sequence in licenses.RULES]
    assert [found for _, found, _ in scan(documents, *texts)] == [name for name, _ in licenses.RULES]


def test_original_bsd_licence(documents):
    advert = f"{SAMPLES['bsd-advert']} acknowledgement: This product includes software. "
    assert scan(documents, BSD.format(advert + NAME))[0][1] == "BSD-4-Clause"


def test_results_written_by_hand(documents):
    """Expected names are of the licences themselves, not of the pattern table."""
    cases = {
        "Dual licensed under the MIT License or the Apache License, Version 2.0.": "Apache-2.0,MIT",
        "Released under the MIT License\nLicensed under CC BY-NC 4.0": "MIT,CC-BY-NC",
        "SPDX-License-Identifier: MIT": "MIT",
        "# SPDX-License-Identifier: Apache-2.0 OR MIT": "Apache-2.0,MIT",
        "code\n// SPDX-License-Identifier: (GPL-2.0-or-later AND BSD-3-Clause)\nmore code": "BSD-3-Clause,GPL-2.0-or-later",
        "SPDX-License-Identifier: CC-BY-SA-4.0": "CC-BY-SA",
        "released under the ISC license": "ISC",
        "You may use version 3 of the GNU General Public License.": "GPL-3.0",
        "under version 2.1 of the GNU Lesser General Public License": "LGPL-2.1",
        "either version 3 or any later version of the GNU General Public License": "GPL-3.0-or-later",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version": "GPL-3.0-or-later",
        "Released under the GPLv3": "GPL-3.0",
        "under the GPL or the Apache License, Version 2.0": "Apache-2.0,GPL",
        "Licensed under the MIT or the BSD 2-Clause licence": "MIT,BSD-2-Clause",
        "Available under the Mozilla Public License v2.0": "MPL-2.0",
        "This file is available under the Mozilla Public License, v. 2.0, and the MIT license.": "MIT,MPL-2.0",
        "The above\ncopyright notice and this permission notice shall be included in all copies.": "",
        "Copyright 2020 Someone, all rights reserved": "All-Rights-Reserved",
        "MIT is a university; a licence to print money": "",
    }
    got = scan(documents, *cases)
    assert [names for _, names, _ in got] == list(cases.values())
    assert got[0][0] == "mit-ref,apache2-ref" and got[16][0] == "mit-notice"


def test_order_of_position(documents):
    text = "The GPL, the MIT License and the GPL again."
    assert scan(documents, text)[0] == ("gpl-ref,mit-ref,gpl-ref", "MIT,GPL", 0)


def test_sql_twin_of_results_written_by_hand(documents, tmp_path):
    texts = [*SAMPLES.values(), MIT, BSD.format(NAME), "SPDX-License-Identifier: MIT\nLicensed under the GPL, v. 2.0", None, ""]
    docs = documents(*[(i, text, "en") for i, text in enumerate(texts)])
    docs.write.parquet(f"{tmp_path}/documents")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    rows = licenses.scan(docs).select("row.doc_id", "sentences", "licenses", "n_unknown")
    names, rows = oracle.spark_rows(rows)
    assert (names, oracle.differences(rows, oracle.duck_rows(con, sql.LICENSES)[1])) == (sorted(names), [])
