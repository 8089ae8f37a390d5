"""Bands, ruled tables and amendment documents against plain forms of their definitions."""

import random

from codexflow.operators import amendment_documents, bands, grids


def reading(words):
    groups, head = [], None
    for w in sorted(words, key=lambda w: (-w["x"], w["at"])):
        if head is None or head - w["x"] > 10:
            groups.append([])
            head = w["x"]
        groups[-1].append(w)
    return "\n".join("".join(w["text"] for w in sorted(g, key=lambda w: w["y"])) for g in groups).strip()


def middle(w):
    return (w["y"] + w["y1"]) / 2


def headings(words):
    groups, head = [], None
    for w in sorted(words, key=lambda w: (w["x"], w["at"])):
        if head is None or w["x"] - head > 6:
            groups.append([])
            head = w["x"]
        groups[-1].append(w)
    for g in groups:
        g.sort(key=lambda w: w["y"])
        letters = [(c, middle(w)) for w in g for c in w["text"]]
        said = "".join(c for c, _ in letters)
        places = [said.find(h) for h in ("改正後", "改正前")]
        if len(g) >= 3 and min(places) >= 0:
            return min(w["x"] for w in g), sum(sum(m for _, m in letters[p : p + 3]) / 3 for p in places) / 2
    return None


def quiet(words, height):
    cuts = [(sum(d["y"] < w["y1"] + 0.5 < d["y1"] for d in words), w["at"], w["y1"] + 0.5) for w in words if 0.35 * height <= w["y1"] + 0.5 <= 0.65 * height]
    if len(words) < 8 or not cuts:
        return None
    cut = min(cuts)[2]
    parts = [[w for w in words if middle(w) < cut], [w for w in words if middle(w) >= cut]]
    if min(map(len, parts)) < 3:
        return None
    tall = [max(w["y1"] for w in p) - min(w["y"] for w in p) for p in parts]
    pairs = [{t[i : i + 2] for i in range(len(t) - 1)} for t in ("".join(reading(p).split()) for p in parts)]
    union = pairs[0] | pairs[1]
    like = len(pairs[0] & pairs[1]) / len(union) if union else 0.0
    return cut if min(tall) / max(tall) >= 0.7 and like >= 0.5 else None


def compared(words, height):
    found = headings(words)
    edge, divider = found or (float("inf"), quiet(words, height))
    if divider is None:
        return None
    label = lambda w: w["text"] in ("改", "正", "後", "前") and abs(w["x"] - edge) < 6
    right = [w for w in words if w["x"] >= edge - 1 and not label(w)]
    upper = [w for w in words if w["x"] < edge - 1 and middle(w) < divider]
    bottom = 2 * divider - min(w["y"] for w in upper) if upper else float("inf")
    lower = [w for w in words if w["x"] < edge - 1 and divider <= middle(w) < bottom]
    return divider, reading(right), reading(upper), reading(lower)


def make_page(rng, kind):
    words, texts = [], [rng.choice("甲乙丙丁") + rng.choice("戊己庚") for _ in range(8)]
    for band in (0, 1):
        for k, t in enumerate(texts):
            y = 60 + 220 * band + 50 * (k % 3) + (rng.choice([0, 10]) if kind == 2 else 0)
            t = "無関" + str(k) if kind == 1 and band else t
            words.append((300 - 13.0 * (k // 3) + rng.choice([0, 2.5]), y, y + 45.0 + (140 if kind == 3 and k == 5 else 0), t))
    if kind == 4:
        words += [(330.0, 100 + 10 * k, 108 + 10 * k, c) for k, c in enumerate("改正後")] + [(331.0, 320 + 10 * k, 328 + 10 * k, c) for k, c in enumerate("改正前")]
        words += [(350.0, 60, 400, "前文"), (280.0, 470, 495, "表の外")]
    rng.shuffle(words)
    return words[: rng.choice([7, 100, 100])] if kind == 0 else words


def test_bands(spark):
    rng, pages = random.Random(4), {}
    for p in range(60):
        pages[p] = [{"at": k, "x": float(x), "y": float(y), "y1": float(y1), "text": t} for k, (x, y, y1, t) in enumerate(make_page(rng, p % 5))]
    rows = [(p, w["at"], w["x"], w["y"], w["y1"], w["text"]) for p, ws in pages.items() for w in ws]
    words = spark.createDataFrame(rows, "page int, at long, x double, y double, y1 double, text string").repartition(3)
    wanted = {p: compared(ws, 500.0) for p, ws in pages.items()}
    found = {r["page"]: tuple(r)[1:] for r in bands.compared_pages(words, "page", 500.0).collect()}
    assert found == {p: w for p, w in wanted.items() if w}
    assert {p % 5 for p in found} >= {0, 2, 4} and not any(p % 5 == 1 for p in found)
    assert "表の外" not in "".join(w[3] for w in found.values())


def lines(values):
    out = []
    for v in sorted(values):
        out = out[:-1] + [out[-1] + [v]] if out and v - out[-1][-1] <= 4 else out + [[v]]
    return [sum(g) / len(g) for g in out]


def table(rules, words, top, bottom, most_x):
    flat = [r for r in rules if r[0] == "h" and top - 2 <= r[1] <= bottom + 12 and r[3] <= most_x and r[3] - r[2] <= 300]
    starts = []
    for v in sorted(r[2] for r in flat):
        starts = starts[:-1] + [starts[-1] + [v]] if starts and v - starts[-1][-1] <= 12 else starts + [[v]]
    found = []
    for s in (sum(g) / len(g) for g in starts):
        own = [r for r in flat if abs(r[2] - s) <= 12]
        if len(own) < 2:
            continue
        lo, hi = min(r[2] for r in own), max(r[3] for r in own)
        ys, xs = lines(r[1] for r in own), lines(r[1] for r in rules if r[0] == "v" and r[2] <= bottom + 12 and r[3] >= top - 2 and lo - 2 <= r[1] <= hi + 2)
        if min(len(ys), len(xs)) < 2:
            continue
        cells = [["".join(w[3] for w in sorted((w for w in words if a <= w[0] < b and c <= (w[1] + w[2]) / 2 < d), key=lambda w: (-w[0], w[1] + w[2]))).strip() for c, d in zip(ys, ys[1:])] for a, b in reversed(list(zip(xs, xs[1:])))]
        full = [(i, j) for i, row in enumerate(cells) for j, t in enumerate(row) if t]
        if full:
            i, j = [x[0] for x in full], [x[1] for x in full]
            found.append((lo, [row[min(j) : max(j) + 1] for row in cells[min(i) : max(i) + 1]]))
    return sorted(found, key=lambda t: -t[0])


def test_several_tables_of_a_page(spark):
    rng, rules, words, bands_, wanted = random.Random(5), [], [], [], {}
    for page in range(12):
        own, said = [], []
        for left, columns, heights in ((60.0, 2, (100, 140, 180)), (150.0, 3, (110, 170)), (260.0, 1, (100, 150, 160, 200)), (20.0, 1, (100,))):
            own += [("h", float(y) + rng.choice([0, 1.5]), left + rng.choice([0, 3.0]), left + 30.0 * columns) for y in heights]
            own += [("v", left + 30.0 * k + rng.choice([0, 1.0]), 100.0, 200.0) for k in range(columns + 1)]
            said += [(left + 30.0 * rng.random() * columns, float(rng.randrange(95, 205)), 0.0, rng.choice("甲乙丙丁") + str(k)) for k in range(rng.choice([0, 3, 9]))]
        own += [("h", 120.0, 0.0, 400.0), ("h", 130.0, 380.0, 420.0)]
        said = [(x, y, y + 4.0, t) for x, y, _, t in said]
        rules += [(page, *r) for r in own]
        words += [(page, *w) for w in said]
        bands_.append((page, 0, 90.0, 210.0, 400.0))
        wanted[page] = table(own, said, 90.0, 210.0, 400.0)
    found = grids.page_tables(
        spark.createDataFrame(rules, "page int, kind string, pos double, low double, high double"),
        spark.createDataFrame(words, "page int, x double, y double, y1 double, text string"),
        spark.createDataFrame(bands_, "page int, band int, y0 double, y1 double, most_x double"),
    ).collect()
    assert sorted((r["page"], r["place"], r["left_x"], r["cells"]) for r in found) == sorted((p, k, x, c) for p, t in wanted.items() for k, (x, c) in enumerate(t))
    assert any(len(t) > 2 for t in wanted.values())


TEXT = """告示第三号
次の表により改正
する。
改正後
（見学の日）
第一条 灯台は、日曜に
開く。
別表第一
甲
（利用料金）
第二条 無料。
別表第二
附則
公布の日から。
改正前
（見学の日）
第一条 灯台は、開かない。
別表第一
（必要人員）
第三条 三人。
改正後
全部
改正前
なし"""


def test_documents(spark):
    docs = spark.createDataFrame([("a", TEXT), ("b", "廃止する。\n以上"), ("c", None), ("d", ""), ("e", "改正後\n別表のみ")], "doc string, text string")
    rows = amendment_documents.document_rows(docs, "doc", "text")
    found = [(r["block"], r["kind"], r["after"], r["before"]) for r in rows.filter("doc = 'a'").orderBy("block", "row").collect()]
    assert found == [
        (0, "paragraph", "告示第三号次の表により改正する。", ""),
        (1, "comparison", "（見学の日）\n第一条 灯台は、日曜に開く。", "（見学の日）\n第一条 灯台は、開かない。"),
        (1, "comparison", "別表第一甲", "別表第一"),
        (1, "comparison", "（利用料金）\n第二条 無料。", ""),
        (1, "comparison", "別表第二", ""),
        (1, "comparison", "", "（必要人員）\n第三条 三人。"),
        (2, "paragraph", "附則公布の日から。", ""),
        (3, "comparison", "全部", "なし"),
    ]
    formats = {r["format"]: r["n"] for r in amendment_documents.format_counts(rows, "doc").collect()}
    assert formats == {"shinkyu": 1, "prose": 1, "unknown": 1}
    tables = spark.createDataFrame(
        [("a", "after", 2, 0, [["p2"]]), ("a", "after", 1, 0, [["p1", ""]]), ("a", "after", 3, 0, [["no slot"]]), ("a", "before", 1, 0, [["old"]]), ("b", "after", 1, 0, [["x"]])],
        "doc string, side string, page int, place int, cells array<array<string>>",
    )
    filled = amendment_documents.with_tables(rows, tables, "doc")
    slots = {r["after"] or r["before"]: (r["after_table"], r["before_table"]) for r in filled.filter("after_table is not null or before_table is not null").collect()}
    assert slots == {"別表第一甲": ([["p1", ""]], [["old"]]), "別表第二": ([["p2"]], None)}
    whole = {r["doc"]: r["blocks"] for r in amendment_documents.documents(filled, "doc").collect()}
    assert [b["kind"] for b in whole["a"]] == ["paragraph", "comparison", "paragraph", "comparison"] and len(whole["a"][1]["rows"]) == 5
    assert set(whole) == {"a", "b", "e"}


def test_amendment_rows_of_documents_with_few_headings(spark, tmp_path):
    """Documents of which a side has no row heading, or only one, have the rows of the SQL too."""
    import parity

    from codexflow.plans.registry import ORACLE_SQL, QUERIES

    rows = [(3, 5), (17, 6), (25, 5), (26, 10), (31, 3), (32, 5), (48, 15), (50, 5), *((60 + k, 7 * k + 1) for k in range(10))]
    parts = [(k, f"name {k % 4}", f"Brand#{k}", "LARGE", size) for k, size in rows]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    con = parity.connect("/root/testdata/sf0.001")
    con.execute(f"create or replace view part as select * from read_parquet('{tmp_path}/part.parquet/*.parquet')")
    assert parity.difference(QUERIES["amendment_document_rows"](spark, str(tmp_path)), con, ORACLE_SQL["amendment_document_rows"]) == ""
