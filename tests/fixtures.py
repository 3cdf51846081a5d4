"""Small order files of the same shape as the reference samples (own rows)."""

from __future__ import annotations

import os

HEADER = "order_id,customer_id,product_name,quantity,price,order_date,status,region"
PRODUCTS = ["Desk Lamp", "Keyboard", "Monitor", "Headphones", "Webcam", "Mouse Pad"]
STATUSES = ["completed", "pending", "shipped"]
REGIONS = ["US-EAST", "US-WEST", "EU-WEST", "ASIA-PACIFIC"]


def baseline_rows(n: int = 30, start: int = 1) -> list[str]:
    rows = []
    for i in range(start, start + n):
        rows.append(
            f"ORD{i:03d},CUST{(i * 7) % 13 + 1:03d},{PRODUCTS[i % len(PRODUCTS)]},{i % 4 + 1},"
            f"{(i * 37) % 500 + 9.99:.2f},2024-01-{(i % 28) + 1:02d},{STATUSES[i % 3]},{REGIONS[i % 4]}"
        )
    return rows


def new_column_rows() -> tuple[str, list[str]]:
    header = HEADER + ",shipping_method"
    rows = [r + ("," + ("express" if i % 2 else "standard")) for i, r in enumerate(baseline_rows(10, start=31))]
    return header, rows


def invalid_rows() -> list[str]:
    # 10 rows; six defects in six different rows.
    return [
        ",CUST001,Desk Lamp,1,19.99,2024-02-01,completed,US-EAST",  # NULL order id
        "ORD041,CUST002,Keyboard,2,49.50,2024-02-02,pending,US-WEST",  # first ORD041: valid
        "ORD041,CUST003,Monitor,1,199.00,2024-02-03,shipped,EU-WEST",  # repeated id
        "ORD042,,Headphones,1,89.90,2024-02-04,completed,ASIA-PACIFIC",  # NULL customer
        "ORD043,CUST004,Webcam,0,59.00,2024-02-05,completed,US-EAST",  # quantity 0
        "ORD044,CUST005,Mouse Pad,3,-499.99,2024-02-06,pending,US-WEST",  # negative price
        "ORD045,CUST006,Desk Lamp,2,24.00,invalid-date,shipped,EU-WEST",  # bad date
        "ORD046,CUST007,Keyboard,1,45.00,2024-02-08,completed,ASIA-PACIFIC",
        "ORD047,CUST008,Monitor,2,210.00,2024-02-09,pending,US-EAST",
        "ORD048,CUST009,Headphones,1,95.00,2024-02-10,shipped,US-WEST",
    ]


def write_csv(folder: str, name: str, header: str, rows: list[str]) -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(header + "\n" + "\n".join(rows) + "\n")
    return path
