from corpusmill.llm import line_dedup as L


def brute(rows, least):
    sites, first = {}, {}
    for i, t, s in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for k, line in enumerate((t or "").split("\n")):
            key = line.strip(L.TRIMMED)
            if key:
                sites.setdefault(key, set()).add(s)
                first.setdefault(key, (i, k))
    out = []
    for i, t, _ in rows:
        if t is not None:
            keep = [x for k, x in enumerate(t.split("\n")) if not (y := x.strip(L.TRIMMED)) or len(sites[y]) < least or first[y] == (i, k)]
            t = "\n".join(keep)
        out.append((i, t))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rows = [(i, f"own {i}\n shared line \n\ntwice\ntwice\nrare {i % 6}\n" + ("last" if i % 2 else ""), None if i % 9 == 8 else f"site{i % 9}") for i in range(40)]
    rows += [(100, None, "site0"), (101, "", "site1"), (102, "\n\n", "site2"), (None, "shared line\nno id", "site3"), (103, "shared line", "site4"), (104, "long " * 20000, "site5")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, site string")
    for least in (3, 5, 8):
        got = L.cleaned(df, L.Settings(min_sites=least)).collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=str) == brute(rows, least)
        assert {r.site for r in got} == {"x"}
    clash = df.selectExpr("*", "1 as n_lines", "2 as removed", "3 as n_removed", "4 as `left`", "5 as `row`", "6 as d", "7 as t")
    kept = L.filter_documents(clash, L.Settings(min_sites=5))
    assert kept.columns == clash.columns and 103 not in {r.doc_id for r in kept.collect()}


def test_repeated_rows_and_empty_table(spark):
    rows = [(i % 3, "same\nown", f"s{i}") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = L.cleaned(df, L.Settings(min_sites=4)).collect()
    assert len(got) == 6 and {r.text for r in got if r.doc_id == 0} == {"same\nown"} and {r.text for r in got if r.doc_id} == {""}
    assert L.cleaned(df.limit(0)).count() == 0
