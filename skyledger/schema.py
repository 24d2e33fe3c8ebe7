"""Names, source positions and types of the flight columns the analyses use."""

from __future__ import annotations

# Input column name, zero-based position in the source file, type.
FLIGHT_FIELDS = (
    ("month", 1, "int"),
    ("op_unique_carrier", 5, "string"),
    ("origin", 7, "string"),
    ("dest", 10, "string"),
    ("dep_delay", 15, "double"),
    ("arr_delay", 22, "double"),
    ("cancelled", 23, "double"),
)

FLIGHT_COLUMNS = tuple(name for name, _, _ in FLIGHT_FIELDS)
SOURCE_POSITIONS = {name: position for name, position, _ in FLIGHT_FIELDS}
FLIGHT_SCHEMA = ", ".join(f"{name} {kind}" for name, _, kind in FLIGHT_FIELDS)

#: What identifies a route row and a ranking row; a row missing one of them belongs to no group.
ROUTE_KEYS = ("op_unique_carrier", "origin", "dest")
PAIR_KEYS = ("origin", "op_unique_carrier")

# Column names of the written reports.
ROUTE_REPORT = ("Compagnia", "Tratta", "Voli", "Min", "Max", "Medio", "Cancellazioni", "Mesi")
ROUTE_LIST = "Dati_Tratte"
RANKING_REPORT = (
    "Aeroporto",
    "Posizione_Classifica",
    "Compagnia",
    "Voli_Operati",
    "Ritardo_Medio_Partenza",
    "Ritardo_Medio_Arrivo",
    "Tasso_Cancellazione",
    "Differenza_Dalla_Media_APT",
)
RANKING_LIST = "Performance_Compagnie"

# Texts that stand for a missing number, and the text written for one.
MISSING_TEXTS = ("", "None")
NULL_TEXT = "NULL"
