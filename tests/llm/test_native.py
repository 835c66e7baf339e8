"""Licence scan and source mix: SQL twins, edge rows, single rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cyclewise.llm import license_rules, mixing, queries
from tests.compare import compare, duck
from tests.llm.edge import SCHEMA, edge_docs


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), queries.SQL[name], duck(sf_dir)) == []


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_edge_rows_equal_sql(spark, tmp_path, name):
    edge_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (7, 1, None), (None, 1, 1), (99, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duck(str(tmp_path))
    for view in ("documents", "labels"):
        con.execute(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM '{tmp_path}/{view}.parquet/*.parquet'")
    assert compare(queries.QUERIES[name](spark, str(tmp_path)), queries.SQL[name], con) == []


def _licenses(spark, text):
    row = license_rules.scan_licenses(spark.createDataFrame([(text,)], "text string")).first()
    return row["licenses"], row["unmatched"]


def test_long_notice_is_one_licence(spark):
    notice = """
    // Licensed under the Apache License, Version 2.0 (the "License");
    // you may not use this file except in compliance with the License.
    // You may obtain a copy of the License at
    //     http://www.apache.org/licenses/LICENSE-2.0
    // Unless required by applicable law or agreed to in writing, software is
    // distributed on an "AS IS" BASIS. See the License for the specific language
    // governing permissions and limitations under the License."""
    assert _licenses(spark, notice)[0] == "Apache-2.0"


def test_wrapped_and_several_licences(spark):
    text = "Some prose.\nReleased under\nthe MIT License. Text. Licensed under CC BY-NC 4.0.\n"
    assert _licenses(spark, text) == ("CC-BY-NC-4.0|MIT", 0)


GNU = """Copyright (C) 2019  A. Person

    This {what} is free software; you can redistribute it and/or modify
    it under the terms of the GNU {name} as published by
    the Free Software Foundation; either version {version} of the License, or
    (at your option) any later version.

    This {what} is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU {name} for more details.

    You should have received a copy of the GNU {name} along
    with this {what}; if not, write to the Free Software Foundation, Inc.,
    51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."""

BSD = """Copyright (c) 2020, The Owner. All rights reserved.

Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES."""

THIRD = """3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software without
   specific prior written permission.
"""

NOTICES = {
    "GPL-2.0-or-later": GNU.format(what="program", name="General Public License", version="2"),
    "GPL-3.0-or-later": GNU.format(what="program", name="General Public License", version="3"),
    "LGPL-2.1-or-later": GNU.format(what="library", name="Lesser General Public License", version="2.1"),
    "LGPL-3.0-or-later": GNU.format(what="library", name="Lesser General Public License", version="3"),
    "AGPL-3.0-or-later": GNU.format(what="program", name="Affero General Public License", version="3"),
    "BSD-3-Clause": BSD.format(third=THIRD),
    "BSD-2-Clause": BSD.format(third=""),
    "Apache-2.0": """Copyright 2021 The Authors

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.""",
    "MIT": """MIT License

Copyright (c) 2022 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.
IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.""",
    "ISC": """ISC License

Copyright (c) 2023, Somebody

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}


@pytest.mark.parametrize("lead", ["", "// ", "# ", " * "])
def test_published_notices(spark, lead):
    """Every notice as published, bare or in comments: its name and nothing left over."""
    texts = [(n, "\n".join(lead + line for line in t.split("\n"))) for n, t in NOTICES.items()]
    out = license_rules.scan_licenses(spark.createDataFrame(texts, "name string, text string"))
    assert {r["name"]: (r["licenses"], r["unmatched"]) for r in out.collect()} == {n: (n, 0) for n in NOTICES}


def test_reserved_rights_beside_a_licence_line(spark):
    assert _licenses(spark, "All rights reserved.\n\nReleased under the MIT License.")[0] == "MIT|Proprietary"


def test_unknown_and_none(spark):
    assert _licenses(spark, "This licence is nobody's business.") == ("UNKNOWN", 1)
    assert _licenses(spark, "No such words.") == ("NONE", 0)
    assert _licenses(spark, None) == ("NONE", 0)


def test_quotas_fill_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("d0", "en", "a", 10, 1), ("d0", "en", "b", 1000, 1), ("d0", "fr", "c", 1000, 1), ("d1", "en", "e", 1000, 1)],
        "domain string, language string, origin string, tokens long, docs long",
    )
    weights = {"domain": {"d0": 50, "d1": 50}, "language": {"en": 50, "fr": 50}, "origin": {}}
    got = {r["origin"]: r["quota"] for r in mixing.plan_quotas(leaves, weights, 40, 1).collect()}
    # 1204 tokens: 602 per domain, 301 per language of d0; a is short by 140, b takes it
    assert got == {"a": 10, "b": 291, "c": 301, "e": 602}


def test_shortage_climbs_when_siblings_are_full(spark):
    leaves = spark.createDataFrame(
        [("d0", "en", "a", 10, 1), ("d0", "fr", "c", 20, 1), ("d1", "en", "e", 1000, 1)],
        "domain string, language string, origin string, tokens long, docs long",
    )
    got = {r["origin"]: r["quota"] for r in mixing.plan_quotas(leaves, {}, 50, 1).collect()}
    assert got == {"a": 10, "c": 20, "e": 485}


def test_mix_keeps_columns_and_never_exceeds_quota(spark):
    docs = edge_docs(spark)
    out = mixing.mix(docs)
    assert set(docs.columns) <= set(out.columns)
    rows = mixing.counted(docs)
    quota = {tuple(r[c] for c in mixing.LEVELS): r["quota"] for r in mixing.plan_mix(rows).collect()}
    taken = mixing.take_mix(rows, mixing.plan_mix(rows)).groupBy(*mixing.LEVELS).agg(F.sum("n_tokens").alias("n"))
    assert all(r["n"] <= quota[tuple(r[c] for c in mixing.LEVELS)] for r in taken.collect())


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert license_rules.scan_licenses(empty).count() == 0
    assert mixing.mix(empty).count() == 0
