import re

import pyarrow as pa
from pyspark.sql import functions as F

from riskspark.llm import licenses

from .conftest import prose


def normal(text):
    return [w for w in re.split(r"[^0-9a-z\u0080-\U0010ffff]+", (text or "").lower()) if w]


def brute(text, templates, share=0.8):
    words, found = normal(text), set()
    for name, template in templates.items():
        t = normal(template)
        k = min(5, len(t))
        wanted = {tuple(t[i : i + k]) for i in range(len(t) - k + 1)}
        # any place: a window of the template's size, so that far apart halves do not add up
        for i in range(max(1, len(words) - len(t) + 1)):
            have = {tuple(words[j : j + k]) for j in range(i, min(i + len(t), len(words)) - k + 1)}
            if len(wanted & have) >= share * len(wanted) - 1e-12:
                found.add(name)
    return found


def test_guarantee_of_every_class():
    for kind in licenses.Scanner(licenses.TEMPLATES).classes:
        assert licenses.collision_probability(licenses.least_resemblance(kind.most), kind.bands) >= licenses.GUARANTEE or kind.most == 1
        # any run of `most` shingles lies inside one window
        assert kind.step * kind.chunks >= kind.most + kind.step - 1


def test_planted_notices_are_found_and_clean_texts_left(spark):
    docs, expected = [], {}
    for i, (name, text) in enumerate(sorted(licenses.TEMPLATES.items()) * 3):
        words = text.split()
        if i >= len(licenses.TEMPLATES) and len(words) > 30:
            words[len(words) // 2] = "altered"  # five shingles differ
        body = prose(i, 30 + 7 * i)
        docs.append((i, body + "\n" + " ".join(words) + ("\n" + prose(1000 + i, 11) if i % 2 else "")))
        expected[i] = brute(docs[-1][1], licenses.TEMPLATES)
        assert name in expected[i]
    docs += [(1000 + i, prose(5000 + i, 300)) for i in range(20)]
    found = {}
    for r in licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect():
        found.setdefault(r.doc_id, set()).add(r.license)
        words = normal(dict(docs)[r.doc_id])
        assert set(normal(licenses.TEMPLATES[r.license])) & set(words[r.start_word : r.end_word])
    assert found == expected


GNU = "you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
{}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
NAMES = "3. Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"


def test_licences_are_told_apart_and_every_notice_of_the_documents_has_a_row(spark):
    cases = {
        "Released under the MIT License.": {"MIT-notice"},
        "Licensed under the Apache License, Version 2.0.": {"Apache-2.0-notice"},
        "This work is licensed under the GNU General Public License, version 3.": {"GPL-3.0-notice"},
        "Licensed under CC BY-NC 4.0.": {"CC-BY-NC-4.0-notice"},
        "All rights reserved.": {"All-rights-reserved"},
        "This work is licensed under the GNU General Public License, version 2.": {"GPL-2.0-notice"},
        "This work is licensed under the GNU Lesser General Public License, version 3.": {"LGPL-3.0-notice"},
        "This work is licensed under the GNU Lesser General Public License, version 2.1.": {"LGPL-2.1-notice"},
        "This work is licensed under the GNU Affero General Public License, version 3.": {"AGPL-3.0-notice"},
        GNU.format("", 2): {"GPL-2.0-or-later"},
        GNU.format("", 3): {"GPL-3.0-or-later"},
        GNU.format("Lesser ", "2.1"): {"LGPL-2.1-or-later"},
        GNU.format("Lesser ", 3): {"LGPL-3.0-or-later"},
        GNU.format("Affero ", 3): {"AGPL-3.0-or-later"},
        BSD.format(""): {"BSD", "BSD-2-Clause"},
        BSD.format(NAMES.format("the copyright holder")): {"BSD", "BSD-3-Clause"},
        BSD.format(NAMES.format("Acme Corp")): {"BSD", "BSD-3-Clause"},
    }
    docs = [(i, f"{prose(i, 40)}\n{text}\n{prose(99 + i, 30)}") for i, text in enumerate(cases)]
    found = {i: set() for i, _ in docs}
    for r in licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        found[r.doc_id].add(r.license)
    assert list(found.values()) == list(cases.values())


def test_two_places_are_two_matches(spark):
    text = f"{prose(1, 50)} Released under the MIT License. {prose(2, 50)} Released under the MIT License."
    got = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r.license, r.containment) for r in got] == [("MIT-notice", 1.0)] * 2 and got[0].end_word <= got[1].start_word


def test_awkward_rows_and_short_template(awkward, empty):
    assert licenses.scan_licenses(awkward.withColumn("license", F.lit("mine"))).count() == 0
    assert licenses.scan_licenses(empty).count() == 0
    got = licenses.scan_licenses(awkward, templates={"short": "ONE!"}).collect()
    assert [r.doc_id for r in got] == [9]


def test_many_templates_are_told_apart():
    templates = {f"t{i}": prose(i, 30 + i % 50) for i in range(1500)}
    scanner = licenses.Scanner(templates)
    asked = [7, 700, 1499]
    texts = pa.array([prose(10_000 + i, 60) + " " + templates[f"t{i}"] + " " + prose(20_000 + i, 60) for i in asked] + [prose(30_000, 200)])
    found = [{m[0] for m in ms if m[1] == 1.0} for ms in scanner.scan(texts)]
    assert found == [{f"t{i}"} for i in asked] + [set()]
