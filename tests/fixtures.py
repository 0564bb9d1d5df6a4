"""A small retail set in the shape of the original sample data.

Planted: a customer without orders (5), an order line of an unknown product
(99), a product name with a comma, a NULL age (customer 4), an even number of
customers, and the pair (Laptop, Mouse) bought together.
"""

from __future__ import annotations

CUSTOMERS = [
    (1, "Ana", "Kota A", 30),
    (2, "Bima", "Kota B", 45),
    (3, "Cita", "Kota A", 52),
    (4, "Dodi", "Kota C", None),
    (5, "Eka", "Kota B", 23),
    (6, "Fajar", "Kota C", 38),
]
CUSTOMER_SCHEMA = "customer_id long, customer_name string, city string, age int"

PRODUCTS = [
    (10, "Laptop", "Elektronik", 1000.0, 5),
    (11, "Mouse", "Elektronik", 20.5, 50),
    (12, "Kopi, Arabika", "Makanan", 7.25, 100),
    (13, "Teh", "Makanan", 3.0, 80),
]
PRODUCT_SCHEMA = "product_id long, product_name string, category string, price double, stock int"

ORDERS = [
    (100, 1, 10, 1.0),
    (101, 1, 11, 2.0),
    (102, 2, 12, 3.0),
    (103, 2, 99, 1.0),  # unknown product
    (104, 3, 10, 1.0),
    (105, 3, 11, 1.0),
    (106, 4, 13, 4.0),
    (107, 6, 12, 1.0),
    (108, 6, 13, 2.0),
    (109, 6, 11, 1.0),
]
ORDER_SCHEMA = "order_id long, customer_id long, product_id long, quantity double"


def frames(spark):
    return (
        spark.createDataFrame(CUSTOMERS, CUSTOMER_SCHEMA),
        spark.createDataFrame(ORDERS, ORDER_SCHEMA),
        spark.createDataFrame(PRODUCTS, PRODUCT_SCHEMA),
    )


def brute_features(unknown="keep"):
    price = {p[0]: p[3] for p in PRODUCTS}
    out = {}
    for cid, name, city, age in CUSTOMERS:
        lines = [o for o in ORDERS if o[1] == cid and (unknown == "keep" or o[2] in price)]
        vals = [o[3] * price[o[2]] for o in lines if o[2] in price]
        total = sum(vals)
        avg = total / len(vals) if vals else 0.0
        out[cid] = (len(lines), round(total, 6), round(avg, 6))
    return out
