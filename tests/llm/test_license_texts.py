"""Whole licence texts, short forms and notices of under five words."""

import duckdb

from stockroute.llm import licenses, queries


def test_texts_and_short_forms_are_found(spark, make_text, tmp_path):
    text = dict(licenses.ALL_TEMPLATES)
    whole = [name for name in text if name.endswith("-text")]
    assert len(whole) == 12
    rows = [(i, make_text(i, 90) + "\n" + text[name] + "\n" + make_text(i + 50, 70)) for i, name in enumerate(whole)]
    rows += [(100, "Licensed under the MIT License"), (101, make_text(9, 40) + " All Rights\nReserved."),
             (102, "MIT License"), (103, "All rights are reserved"), (104, make_text(10, 6000)),
             (105, " ".join(text["MIT-text"].split()[40:])), (106, " ".join(text["GPL-3.0-text"].split()[:2500])),
             (107, "Licensed under the GNU Lesser General Public License"), (108, None), (109, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["license"]): r["containment"] for r in licenses.scan(docs).collect()}
    assert all(got[i, name] == 1.0 for i, name in enumerate(whole))
    of = lambda i: {k[1] for k in got if k[0] == i}
    assert of(100) == {"MIT-licensed", "MIT-name"} and of(101) == {"All-rights-reserved"} and of(102) == {"MIT-name"}
    assert of(107) == {"LGPL-licensed"} and "MIT-text" not in of(105) and "GPL-3.0-text" not in of(106)
    assert not {103, 104, 108, 109} & {i for i, _ in got}
    # the statement of the registered query over the same documents
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = {(i, name): (round(c, 9), first) for i, name, c, first in con.execute(queries.ORACLES["op2_license_scan"]).fetchall()}
    mine = queries.QUERIES["op2_license_scan"](spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["license"]): (round(r["containment"], 9), r["first_word"]) for r in mine} == want
