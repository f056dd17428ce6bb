"""A small shop in the native table shapes, with the cases that are easy to get wrong."""

from __future__ import annotations

from tradeloom.sources.catalog import SOURCES

DAY = "2017-05-{:02d} 10:00:00"

ROWS: dict[str, list[tuple]] = {
    # order, customer, status, bought, approved, shipped, delivered, estimated
    "orders": [
        ("o1", "c1", "delivered", "2017-05-01 23:00:00", "", None, "2017-05-02 01:00:00", "2017-05-09"),
        ("o2", "c2", "delivered", DAY.format(3), "2017", "soon", DAY.format(9), DAY.format(9)),
        ("o3", "c3", "delivered", DAY.format(4), None, None, DAY.format(20), DAY.format(9)),
        ("o4", "c4", "shipped", DAY.format(5), None, DAY.format(6), None, DAY.format(30)),
        ("o5", "c5", "delivered", DAY.format(6), None, None, DAY.format(8), None),
        ("o6", "c6", "delivered", DAY.format(7), None, None, "2017-05-01 00:00:00", DAY.format(9)),
        ("o7", "nobody", "canceled", "never", None, None, DAY.format(8), "2017-05-01"),
        ("o8", "c1b", "delivered", "2018-01-05 08:00:00", None, None, "2018-01-07", "2018-01-09"),
        ("o9", "c7", "delivered", "2018-02-01", None, None, "2018-02-03", "2018-02-09"),
    ],
    "customers": [
        ("c1", "p1", "01234", "Sao Paulo", "SP"),
        ("c1b", "p1", "20000", "Rio", "RJ"),
        ("c2", "p2", "01000", "Sao Paulo", "SP"),
        ("c3", "p3", "01000", "Sao Paulo", "SP"),
        ("c4", "p4", "70000", "Brasilia", None),
        ("c5", "p5", "70000", "D'Oeste", "O'D"),
        ("c6", "p6", "30000", "Belo Horizonte", "MG"),
        ("c7", "p7", "30000", "Belo Horizonte", "MG"),
        ("c8", "p8", "30000", "Nowhere", "MG"),
    ],
    "order_items": [
        ("o1", 1, "x1", "s1", DAY.format(3), "10.00", "1.50"),
        ("o1", 2, "x2", "s1", DAY.format(3), "20.00", "2.50"),
        ("o2", 1, "x3", "s2", "bad", "150.00", None),
        ("o4", 1, "x9", "s9", DAY.format(3), "5.00", "0.00"),
        ("o6", 1, "x1", "s2", DAY.format(3), "7.00", "0.10"),
        ("lost", 1, "x1", "s1", DAY.format(3), "9.00", "0.10"),
    ],
    "order_payments": [
        ("o1", 1, "voucher", 1, "10.00"),
        ("o1", 2, "credit_card", 3, "20.00"),
        ("o1", 3, "voucher", 2, "4.00"),
        ("o2", 1, "boleto", 1, "150.00"),
        ("o3", 1, None, 1, "499.99"),
        ("o4", 1, "boleto", 1, "500.00"),
        ("o6", 1, "boleto", 1, "-3.00"),
        ("o8", 1, "boleto", 1, "100.00"),
        ("o9", 1, "boleto", 1, "149.99"),
    ],
    # review, order, score, title, message, created, answered
    "order_reviews": [
        ("r1", "o1", 2, None, "first", "2017-05-10", "2017-05-11"),
        ("r2", "o1", 5, "ok", 'second, "late"\nand more', "2017-05-12", "2017-05-13"),
        ("r3", "o2", 1, None, None, "2017-05-12", None),
        ("r4", "o2", 4, None, None, "2017-05-12", None),
        ("r5", "o3", 7, None, None, "unknown", None),
        ("r6", "o3", 3, None, None, "2017-05-01", None),
    ],
    "products": [
        ("x1", "beleza", 1, 100.0, 1.0, 2.0, 3.0),
        ("x2", "sem_traducao", 2, 200.0, 1.0, 2.0, 3.0),
        ("x3", None, None, None, None, None, None),
    ],
    "sellers": [("s1", "01234", "Campinas", "SP"), ("s2", "20000", "Rio", "RJ")],
    "product_category_translation": [("beleza", "beauty"), ("livros", "books")],
}


def raw_frames(spark, replaced: dict[str, list[tuple]] | None = None) -> dict:
    frames = {}
    for name, rows in {**ROWS, **(replaced or {})}.items():
        columns = SOURCES[name].columns
        text = ", ".join(
            f"{column} {'string' if kind.startswith('decimal') else kind}"
            for column, kind in columns.items()
        )
        frame = spark.createDataFrame(rows, text)
        frames[name] = frame.select(*[frame[c].cast(kind).alias(c) for c, kind in columns.items()])
    return frames


def write_csvs(folder, prefix: str = "shop_") -> None:
    for name, spec in SOURCES.items():
        first = prefix if spec.file.endswith("dataset") else ""
        lines = [",".join(spec.columns)]
        lines += [",".join(quoted(item) for item in row) for row in ROWS[name]]
        (folder / f"{first}{spec.file}.csv").write_text("\n".join(lines) + "\n")


def quoted(item, always: bool = False) -> str:
    if item is None:
        return ""
    text = str(item)
    if always or any(mark in text for mark in ',"\n'):
        return '"' + text.replace('"', '""') + '"'
    return text
