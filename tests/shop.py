"""A small raw shop, drawn from a seed: what the layer tests land."""

import random

from strata import fixed


def raw_shop(spark, customers=20, orders=40, reviews=15, dirty=True, seed=1):
    """The six raw tables, all text. ``dirty``: repeated orders and negative amounts, no failed ERROR check."""
    rng = random.Random(seed)
    day = lambda: f"20{rng.randrange(20, 26)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}"
    cents = lambda: f"{rng.randrange(100, 90000) / 100:.2f}"
    rows = {t: [] for t in fixed.TABLES}
    for c in range(1, customers + 1):
        rows["customers"].append((f"C{c:05d}", f"Person {c}", f"p{c}@shop.test" if c % 7 else None, rng.choice(["N", "S", None]), "Town", day()))
    for p in range(1, 13):
        rows["products"].append((f"P{p:04d}", f"Thing {p}" if p % 5 else None, rng.choice(["Tools", "Toys", "Food"]), cents(), str(rng.randrange(90))))
    for o in range(1, orders + 1):
        order, who, items = f"O{o:06d}", f"C{rng.randrange(1, customers + 1):05d}", rng.randrange(1, 4)
        rows["orders"].append((order, who, day(), rng.choice(["shipped", " Delivered", "processing"]), cents()))
        rows["payments"].append((f"PAY{o:06d}", order, rng.choice(["pix", " BOLETO "]), "1", cents()))
        for i in range(1, items + 1):
            rows["order_items"].append((order, f"{order}-I{i}", f"P{rng.randrange(1, 13):04d}", str(rng.randrange(1, 6)), cents()))
        if o <= reviews:
            rows["reviews"].append((f"R{o:06d}", order, who, str(rng.randrange(1, 6)), rng.choice(["fine", None]), day()))
    if dirty:
        rows["orders"] += rows["orders"][:5]
        rows["orders"][7] = (*rows["orders"][7][:4], "-12.50")
        rows["payments"][3] = (*rows["payments"][3][:4], "-1.00")
        rows["order_items"][2] = (*rows["order_items"][2][:3], "-4", "2.00")
    return {t: spark.createDataFrame(r, ", ".join(f"{c} string" for c in fixed.RAW_COLUMNS[t])) for t, r in rows.items()}


def write_shop(tables, uri):
    from strata.sources.files import write_csv

    for t, df in tables.items():
        write_csv(df, f"{uri}/{t}.csv")
