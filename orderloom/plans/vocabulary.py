"""Business vocabulary of the warehouse. Everything here is a fixed value."""

from __future__ import annotations

from typing import NamedTuple


class Status(NamedTuple):
    detail: str
    group: str
    terminal: bool


CANCELLED = "Cancelled"

# The order statuses, what they roll up to, and whether they are final.
STATUSES = [
    Status("Shipped", "Shipped", False),
    Status("Shipped - Delivered to Buyer", "Delivered", True),
    Status("Cancelled", "Cancelled", True),
    Status("Shipped - Returned to Seller", "Returned", True),
    Status("Shipped - Picked Up", "Delivered", True),
    Status("Pending", "Pending", False),
    Status("Pending - Waiting for Pick Up", "Pending", False),
    Status("Shipped - Returning to Seller", "Returned", True),
    Status("Shipped - Out for Delivery", "Delivered", True),
    Status("Shipped - Rejected by Buyer", "Returned", True),
    Status("Shipping", "Pending", False),
    Status("Shipped - Lost in Transit", "Returned", True),
    Status("Shipped - Damaged", "Returned", True),
]
STATUS_GROUPS = ["Delivered", "Shipped", "Pending", "Cancelled", "Returned"]
TERMINAL_GROUPS = ["Delivered", "Cancelled", "Returned"]
OPEN_GROUPS = ["Shipped", "Pending"]
SOLD_GROUPS = ["Delivered", "Shipped"]
COURIER_STATUSES = ["Shipped", "Unshipped", "Cancelled"]

# Seasons by month; the remaining months are winter.
SEASON_MONTHS = {"Spring": [3, 4], "Summer": [5, 6], "Monsoon": [7, 8, 9], "Autumn": [10, 11]}
OTHER_SEASON = "Winter"
SEASONS = [*SEASON_MONTHS, OTHER_SEASON]

# Stand-ins for a missing address field and for an unmapped region.
UNKNOWN_PLACE = "UNKNOWN"
UNKNOWN_REGION = "Unknown"
REGIONS = ["North", "South", "East", "West", "Northeast", "Central", UNKNOWN_REGION]

# Default calendar, first day and the day after the last.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2031-01-01"

# Region lookup as (country, state, region).
STATE_REGIONS = [
    ("IN", "ANDHRA PRADESH", "South"),
    ("IN", "ARUNACHAL PRADESH", "Northeast"),
    ("IN", "ASSAM", "Northeast"),
    ("IN", "BIHAR", "East"),
    ("IN", "CHHATTISGARH", "Central"),
    ("IN", "GOA", "West"),
    ("IN", "GUJARAT", "West"),
    ("IN", "HARYANA", "North"),
    ("IN", "HIMACHAL PRADESH", "North"),
    ("IN", "JHARKHAND", "East"),
    ("IN", "KARNATAKA", "South"),
    ("IN", "KERALA", "South"),
    ("IN", "MADHYA PRADESH", "Central"),
    ("IN", "MAHARASHTRA", "West"),
    ("IN", "MANIPUR", "Northeast"),
    ("IN", "MEGHALAYA", "Northeast"),
    ("IN", "MIZORAM", "Northeast"),
    ("IN", "NAGALAND", "Northeast"),
    ("IN", "ODISHA", "East"),
    ("IN", "PUNJAB", "North"),
    ("IN", "RAJASTHAN", "North"),
    ("IN", "SIKKIM", "Northeast"),
    ("IN", "TAMIL NADU", "South"),
    ("IN", "TELANGANA", "South"),
    ("IN", "TRIPURA", "Northeast"),
    ("IN", "UTTAR PRADESH", "North"),
    ("IN", "UTTARAKHAND", "North"),
    ("IN", "WEST BENGAL", "East"),
    ("IN", "ANDAMAN AND NICOBAR ISLANDS", "East"),
    ("IN", "CHANDIGARH", "North"),
    ("IN", "DADRA AND NAGAR HAVELI AND DAMAN AND DIU", "West"),
    ("IN", "DELHI", "North"),
    ("IN", "JAMMU AND KASHMIR", "North"),
    ("IN", "LADAKH", "North"),
    ("IN", "LAKSHADWEEP", "South"),
    ("IN", "PUDUCHERRY", "South"),
]
