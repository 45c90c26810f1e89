"""Small records with known contents."""

import json

# Name, quantity, unit price, amount; the amounts add up, the tax is one tenth rounded down.
LINES = [
    ("Beech plank, 2 m", 12, 1850, 22200),
    ("Wood glue", 3, 645, 1935),
    ("Sawing, per cut", 7, 90, 630),
    ("Delivery (ground floor)", 1, 4500, 4500),
]
SUBTOTAL, TAX, TOTAL = 29265, 2926, 32191

GOLDEN = {
    "issue_date": "2023-05-17",
    "billing_name": "Bakery Müller & Daughters",
    "supplier": {
        "zip_code": "550-1234",
        "address": "7 Mill Lane, Oakford",
        "company_name": "",
        "department_name": "Workshop",
    },
    "details": [
        dict(zip(("item_name", "item_quantity", "item_unit_price", "item_amount"), line))
        for line in LINES
    ],
    "subtotal": SUBTOTAL,
    "consumption_tax": TAX,
    "total_amount": TOTAL,
    "remarks": "",
}


def golden(**changes) -> str:
    return json.dumps(GOLDEN | changes, ensure_ascii=False)


def golden_supplier(**changes) -> str:
    return golden(supplier=GOLDEN["supplier"] | changes)


# The same kind of document under keys the specification does not know.
FOREIGN_KEYS = json.dumps(
    {"Rechnungsdatum": "2023-05-17", "Posten": [{"Artikel": "Leim", "Menge": 1}], "Summe": 645}
)
