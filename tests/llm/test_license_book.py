"""Headings, notices and SPDX expressions by label; detections of one text grow in proportion."""

import time

from docloom.llm import licenses

HEADINGS = {
    "Apache License Version 2.0, January 2004": "apache-2.0", "Mozilla Public License Version 2.0": "mpl-2.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1": "lgpl-2.1",
    "BSD 3-Clause License": "bsd-3-clause", "Boost Software License - Version 1.0": "bsl-1.0", "GNU AFFERO GENERAL PUBLIC LICENSE": "agpl-3.0", "The MIT License (MIT)": "mit",
    "Creative Commons Attribution-ShareAlike 4.0 International": "cc-by-sa-4.0", "EUROPEAN UNION PUBLIC LICENCE v. 1.2": "eupl-1.2", "The Unlicense": "unlicense", "SIL OPEN FONT LICENSE Version 1.1": "ofl-1.1",
    "SPDX-License-Identifier: (MIT OR Apache-2.0)": "apache-2.0,mit", "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0": "gpl-2.0,gpl-2.0-classpath",
    "SPDX-License-Identifier: MIT AND BSD-3-Clause-Clear AND Zlib": "bsd-3-clause-clear,mit,zlib", "SPDX-License-Identifier: MIT, by Foo and Ruby": "mit",
    "you can redistribute it under the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version": "gpl-2.0-or-later",
    "ein Satz mit Lizenz": "",
}


def test_headings(spark):
    frame = spark.createDataFrame(list(enumerate(HEADINGS)), "doc_id long, text string")
    got = {r.doc_id: ",".join(sorted({x.label for x in r.found if x.score >= 0.7})) for r in licenses.scan(frame).collect()}
    assert [got[i] for i in range(len(HEADINGS))] == list(HEADINGS.values())


def test_most_rules_are_written_by_hand():
    from docloom.llm import license_rules

    assert len(license_rules._written()) > 300 and len({r.pattern for r in license_rules._written()}) == len(license_rules._written())


def test_time_grows_with_the_detections(spark):
    def seconds(n):
        frame = spark.createDataFrame([(1, "mit license, gpl v2. and cc by 4.0; " * n)], "doc_id long, text string")
        start = time.perf_counter()
        r = licenses.scan(frame).first()
        assert len(r.base) == 2 * n and len(r.found) == 3 * n
        return time.perf_counter() - start

    seconds(100)
    a, b = seconds(10_000), seconds(20_000)
    assert b < 3 * a + 1
