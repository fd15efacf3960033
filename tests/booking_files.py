"""Generated raw files with every anomaly the cleaning rules know."""

from __future__ import annotations

import csv
import os
from datetime import date, timedelta
from random import Random

DAY0 = date(2024, 1, 1)


def _write(folder, name, header, lines):
    with open(os.path.join(folder, f"{name}.csv"), "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows([["" if v is None else v for v in line] for line in lines])


def write_files(folder: str, seed: int = 11, bookings: int = 120) -> dict[str, list[list]]:
    """Five tables and reviews; returns the lines per table."""
    rng = Random(seed)
    hotels = [[f"H{i}", f"Hotel {i}", 3 + i % 3, "XX" if i == 1 else "IT"] for i in range(1, 5)]
    rooms = [[f"H{1 + i % 4}-R{i}", f"H{1 + i % 4}", "STD", "Standard", 2] for i in range(12)]
    rooms.append(list(rooms[3]))
    customers = [
        [f"C{i}", f"First{i}", f"Last{i}", ["", " ", "null", "NULL", f"c{i}@mail"][i % 5], "IT", i % 2]
        for i in range(20)
    ]
    customers.append(list(customers[7]))
    booked = []
    for i in range(bookings):
        room = rooms[rng.randrange(12)]
        start = DAY0 + timedelta(days=rng.randrange(60))
        end = start + timedelta(days=rng.randrange(0, 8))
        if i % 17 == 3:
            start, end = end, start
        total = rng.randrange(5000, 90000) / 100
        booked.append([
            f"B{i:04}", f"C{rng.randrange(20)}", room[1], room[0], DAY0,
            "not a date" if i % 41 == 5 else start, None if i % 37 == 4 else end,
            abs((end - start).days), "XXX" if i % 13 == 2 else rng.choice(["EUR", "USD", "GBP"]),
            None if i % 29 == 7 else f"{-total if i % 19 == 6 else total:.2f}",
            rng.choice(["confirmed", "confirmed", "cancelled"]), rng.choice(["web", "desk", "agent"]),
        ])
    paid = []
    for i in range(100):
        parent = booked[rng.randrange(bookings)]
        total = float(parent[9] or 100)
        amount = total * 2 if i % 23 == 5 else abs(total) * rng.random()
        paid.append([
            f"P{i:04}", "B999999" if i % 21 == 4 else None if i % 33 == 8 else parent[0], "card",
            "paid", f"{amount:.2f}", "ZZZ" if i % 16 == 3 else "EUR", DAY0,
        ])
    reviews = [[f"C{i % 15}", t] for i, t in enumerate(
        ["great stay", "bad, bad room", "fine", "", "Great! not bad", "awful"] * 5)]
    reviews.append(["", "great"])
    _write(folder, "hotels", ["hotel_id", "hotel_name", "stars", "country"], hotels)
    _write(folder, "rooms", ["room_id", "hotel_id", "room_type_code", "room_type_desc", "max_occupancy"], rooms)
    _write(folder, "customers",
           ["customer_id", "first_name", "last_name", "email", "country", "gdpr_optin"], customers)
    _write(folder, "bookings",
           ["booking_id", "customer_id", "hotel_id", "room_id", "created_at", "checkin_date",
            "checkout_date", "nights", "currency", "total_amount", "status", "source"], booked)
    _write(folder, "payments",
           ["payment_id", "booking_id", "provider", "status", "amount", "currency",
            "transaction_date"], paid)
    _write(folder, "reviews", ["customer_id", "review_text"], reviews)
    return {"hotels": hotels, "rooms": rooms, "customers": customers, "bookings": booked,
            "payments": paid, "reviews": reviews}
