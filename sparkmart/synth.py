"""Synthetic retail data at any size (G1–G4), generated by Spark.

Every random draw is a seeded hash of the row id (``xxhash64(id, salt)``),
so each task generates its own rows independently, any partition can be
regenerated after an executor loss, and the output does not depend on the
number of tasks.  Draws follow the original generator's distributions;
its exact numbers (a single-machine random stream) are not reproduced.

Planted patterns (G4): an order line of a trigger product is followed, with
the pattern's probability (one roll per trigger line), by one line per
companion product, quantity 1–3, same customer and date.  Companion ids are
derived from (order id, position), not from a running counter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Catalogue, names, cities and planted patterns of the original
# large-dataset generator.
CITIES = [
    "Jakarta", "Surabaya", "Bandung", "Medan", "Makassar",
    "Semarang", "Palembang", "Depok", "Tangerang", "Bekasi",
]
CATALOG: dict[str, list[str]] = {
    "Elektronik": ["Laptop", "Mouse", "Keyboard", "Monitor", "Webcam",
                   "Headphone", "Smartphone", "Tablet", "Printer", "Speaker"],
    "Fashion": ["Jaket", "Celana", "Kemeja", "Kaos", "Sepatu",
                "Topi", "Tas", "Dompet", "Ikat Pinggang", "Kacamata"],
    "Makanan": ["Kopi", "Teh", "Gula", "Minyak Goreng", "Beras",
                "Mie Instan", "Kecap", "Saus", "Susu", "Coklat"],
    "Olahraga": ["Sepatu Lari", "Bola", "Raket", "Matras Yoga", "Dumbbell",
                 "Jersey", "Pelindung Lutut", "Tas Olahraga", "Topi Olahraga", "Kaos Kaki"],
    "Dapur": ["Panci", "Blender", "Wajan", "Pisau Dapur", "Talenan",
              "Rice Cooker", "Kompor", "Kulkas Mini", "Toaster", "Thermos"],
    "Kecantikan": ["Sabun", "Shampo", "Kondisioner", "Pelembab", "Sunscreen",
                   "Lipstik", "Maskara", "Foundation", "Parfum", "Deodoran"],
    "Otomotif": ["Helm", "Sarung Tangan Motor", "Cover Motor", "Oli Motor", "Ban Motor",
                 "Lampu Motor", "Kunci Cadangan", "Jas Hujan", "Kaca Spion", "Klakson"],
    "Buku": ["Novel", "Komik", "Buku Pelajaran", "Majalah", "Buku Resep",
             "Buku Motivasi", "Kamus", "Atlas", "Buku Gambar", "Planner"],
    "Kesehatan": ["Vitamin C", "Masker", "Hand Sanitizer", "Obat Flu", "Termometer",
                  "Tensimeter", "Bandage", "Antiseptik", "Probiotik", "Suplemen"],
    "Rumah": ["Bantal", "Selimut", "Gorden", "Karpet", "Lampu LED",
              "Cermin", "Rak Dinding", "Tempat Sampah", "Sapu", "Taplak Meja"],
}
FIRST_NAMES = ["Adi", "Budi", "Citra", "Dewi", "Eko", "Fani", "Gilang", "Hana", "Irfan", "Julia",
               "Krisna", "Linda", "Mario", "Nina", "Oscar", "Putri", "Qadir", "Rina", "Sandi", "Tina"]
LAST_NAMES = ["Santoso", "Wijaya", "Kusuma", "Pratama", "Hidayat", "Sari", "Rahman", "Utama",
              "Putra", "Dewi", "Susanto", "Wibowo", "Hartono", "Nugroho", "Setiawan"]
PATTERNS: list[tuple[str, list[str], float]] = [
    ("Laptop", ["Mouse", "Keyboard"], 0.65),
    ("Smartphone", ["Headphone", "Speaker"], 0.55),
    ("Kopi", ["Teh", "Gula"], 0.60),
    ("Jaket", ["Celana"], 0.55),
    ("Sepatu Lari", ["Kaos Kaki", "Bola"], 0.50),
    ("Panci", ["Blender", "Wajan"], 0.50),
    ("Sabun", ["Shampo", "Kondisioner"], 0.60),
    ("Helm", ["Sarung Tangan Motor", "Jas Hujan"], 0.55),
]
N_CUSTOMERS = 10_000
N_ORDERS = 1_000_000
SEED = 42
CUSTOMER_EPOCH = "2022-01-01"
ORDER_EPOCH = "2023-01-01"
DAYS = 730


def _draw(id_col: Column, salt: int, lo: int, hi: int) -> Column:
    """Uniform integer in [lo, hi] from a seeded hash of the id."""
    return (F.lit(lo) + F.pmod(F.xxhash64(id_col, F.lit(SEED), F.lit(salt)), F.lit(hi - lo + 1)))


def _uniform(id_col: Column, salt: int) -> Column:
    """Uniform double in [0, 1)."""
    h = F.pmod(F.xxhash64(id_col, F.lit(SEED), F.lit(salt)), F.lit(1 << 53))
    return h.cast(T.DoubleType()) / F.lit(float(1 << 53))


def products(spark: SparkSession) -> DataFrame:
    """G1: 10 categories × 10 names; price 5,000–2,000,000, stock 10–500."""
    rows = []
    pid = 1
    for category, names in CATALOG.items():
        for name in names:
            rows.append((pid, name, category))
            pid += 1
    base = spark.createDataFrame(rows, "product_id int, name string, category string")
    pid_col = F.col("product_id")
    return base.select(
        "product_id", "name", "category",
        _draw(pid_col, 1, 5_000, 2_000_000).cast(T.IntegerType()).alias("price"),
        _draw(pid_col, 2, 10, 500).cast(T.IntegerType()).alias("stock"),
    )


def customers(spark: SparkSession, n: int = N_CUSTOMERS) -> DataFrame:
    """Cycling first/last names, 10 cities, age 18–60, signup over 730 days."""
    i = F.col("id") - 1
    first = F.element_at(F.array(*[F.lit(x) for x in FIRST_NAMES]),
                         (F.pmod(i, F.lit(len(FIRST_NAMES))) + 1).cast(T.IntegerType()))
    last = F.element_at(F.array(*[F.lit(x) for x in LAST_NAMES]),
                        (F.pmod(i, F.lit(len(LAST_NAMES))) + 1).cast(T.IntegerType()))
    cycle = len(FIRST_NAMES) * len(LAST_NAMES)
    name = F.when(i >= cycle, F.concat_ws(" ", first, last, (F.floor(i / cycle) + 1).cast("string"))) \
        .otherwise(F.concat_ws(" ", first, last))
    city = F.element_at(F.array(*[F.lit(c) for c in CITIES]),
                        _draw(F.col("id"), 3, 1, len(CITIES)).cast(T.IntegerType()))
    return spark.range(1, n + 1).select(
        F.col("id").cast(T.IntegerType()).alias("customer_id"),
        name.alias("name"),
        city.alias("city"),
        _draw(F.col("id"), 4, 18, 60).cast(T.IntegerType()).alias("age"),
        F.date_add(F.lit(CUSTOMER_EPOCH).cast("date"),
                   _draw(F.col("id"), 5, 0, DAYS - 1).cast(T.IntegerType())).alias("signup_date"),
    )


def base_orders(spark: SparkSession, n: int = N_ORDERS, n_customers: int = N_CUSTOMERS,
                n_products: int = 100, num_partitions: int | None = None) -> DataFrame:
    """Uniform customer and product, quantity 1–5, date over 730 days."""
    ids = spark.range(1, n + 1, numPartitions=num_partitions)
    oid = F.col("id")
    return ids.select(
        oid.alias("order_id"),
        _draw(oid, 6, 1, n_customers).cast(T.IntegerType()).alias("customer_id"),
        _draw(oid, 7, 1, n_products).cast(T.IntegerType()).alias("product_id"),
        _draw(oid, 8, 1, 5).cast(T.IntegerType()).alias("quantity"),
        F.date_add(F.lit(ORDER_EPOCH).cast("date"),
                   _draw(oid, 9, 0, DAYS - 1).cast(T.IntegerType())).alias("order_date"),
    )


def pattern_table(spark: SparkSession, prods: DataFrame) -> DataFrame:
    """Trigger product id → companion ids and probability (8 rows)."""
    ids = {r["name"]: r["product_id"] for r in prods.select("name", "product_id").collect()}
    rows = [(ids[t], [ids[c] for c in comp if c in ids], p) for t, comp, p in PATTERNS if t in ids]
    return spark.createDataFrame(rows, "trigger_id int, companions array<int>, probability double")


def orders(spark: SparkSession, n: int = N_ORDERS, n_customers: int = N_CUSTOMERS,
           num_partitions: int | None = None) -> DataFrame:
    """G3 + G4: base orders plus planted companion lines.

    The pattern table has 8 rows (fixed), so the join is a broadcast; a
    companion line's id is ``n + 2 * (order_id - 1) + position + 1`` —
    unique because no pattern has more than two companions.
    """
    prods = products(spark)
    base = base_orders(spark, n, n_customers, prods.count(), num_partitions)
    pats = F.broadcast(pattern_table(spark, prods))
    fired = base.join(pats, base.product_id == pats.trigger_id, "inner").where(
        _uniform(F.col("order_id"), 10) < F.col("probability")
    )
    extra = fired.select(
        "order_id", "customer_id", "order_date", F.posexplode("companions").alias("pos", "companion")
    ).select(
        (F.lit(n) + (F.col("order_id") - 1) * 2 + F.col("pos") + 1).alias("order_id"),
        "customer_id",
        F.col("companion").alias("product_id"),
        _draw(F.col("order_id") * 2 + F.col("pos"), 11, 1, 3).cast(T.IntegerType()).alias("quantity"),
        "order_date",
    )
    return base.unionByName(extra)


def dataset(spark: SparkSession, n_orders: int = N_ORDERS, n_customers: int = N_CUSTOMERS,
            num_partitions: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(customers, orders, products) in the large layout (``name`` columns)."""
    return customers(spark, n_customers), orders(spark, n_orders, n_customers, num_partitions), products(spark)
