"""Names of teams and positions, and the teams that a file's name holds."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalar import mapped

#: The teams by full name, with the codes that the stored tables use.
TEAMS = {
    "Arizona Cardinals": "ARI", "Atlanta Falcons": "ATL", "Baltimore Ravens": "BAL", "Buffalo Bills": "BUF", "Carolina Panthers": "CAR", "Chicago Bears": "CHI", "Cincinnati Bengals": "CIN",
    "Cleveland Browns": "CLE", "Dallas Cowboys": "DAL", "Denver Broncos": "DEN", "Detroit Lions": "DET", "Green Bay Packers": "GNB", "Houston Texans": "HOU", "Indianapolis Colts": "IND",
    "Jacksonville Jaguars": "JAX", "Kansas City Chiefs": "KAN", "Las Vegas Raiders": "LVR", "Los Angeles Chargers": "LAC", "Los Angeles Rams": "LAR", "Miami Dolphins": "MIA",
    "Minnesota Vikings": "MIN", "New England Patriots": "NWE", "New Orleans Saints": "NOR", "New York Giants": "NYG", "New York Jets": "NYJ", "Philadelphia Eagles": "PHI",
    "Pittsburgh Steelers": "PIT", "San Francisco 49ers": "SFO", "Seattle Seahawks": "SEA", "Tampa Bay Buccaneers": "TAM", "Tennessee Titans": "TEN", "Washington Commanders": "WAS",
}

#: The groups of positions, with the spellings that lists use for each.
POSITIONS = {
    "QB": ["QB"], "RB": ["RB"], "WR": ["WR"], "TE": ["TE", "TE/QB"], "FB": ["FB/DL"],
    "OL": ["G", "C", "OG", "IOL", "OL", "LG", "RG", "LG/RG", "LG/RT", "C/RG", "LT/RT", "T-G", "RG/LG", "RG/LT", "T", "OT", "RT", "LT", "RT/LT"],
    "DL": ["DE", "DT", "NT", "LDE", "RDE", "LDE/RDE", "LDT", "RDT", "LDT/RDT", "DT/LB", "RDE/LDE"],
    "LB": ["LB", "ILB", "MLB", "RLB/MLB", "OLB", "LOLB", "ROLB", "LILB", "RILB", "LILB/RILB", "RILB/LILB", "LLB", "RLB", "MLB/RLB", "KB"],
    "DB": ["CB", "DB", "LCB", "RCB", "LCB/RCB", "FS", "SS", "S", "SS/FS", "LBC/DB", "DB/LCB", "LCB/DB"], "K": ["K", "PK"], "P": ["P"], "LS": ["LS"],
}


def nickname(name: str) -> str:
    """The last word of a team's name."""
    return name.rsplit(" ", 1)[-1]


def team_code(x: Column) -> Column:
    """The code of a team by its full name; others stay as they are."""
    return mapped(x, TEAMS)


def code_of_nickname(x: Column) -> Column:
    """The code of a team by its nickname; others stay as they are."""
    return mapped(x, {nickname(n): c for n, c in TEAMS.items()})


def name_of_nickname(x: Column) -> Column:
    """The full name of a team by its nickname; others stay as they are."""
    return mapped(x, {nickname(n): n for n in TEAMS})


def position_group(x: Column) -> Column:
    """The group of a position; spellings that no group has stay as they are."""
    return mapped(x, {spelling: group for group, spellings in POSITIONS.items() for spelling in spellings})


def teams_in_path(path: Column) -> Column:
    """Struct (first, second) of the teams in ``.../cleaned_First_Team_Second_Team_wk5_2024.csv``.

    The part before ``_wk`` begins with one known name and ends with another, whatever the number of
    their words. Null where there is no such part, or a name that is not known.
    """
    known = "|".join(re.escape(name.replace(" ", "_")) for name in TEAMS)
    pattern = rf"^(?:.*[/\\])?(?:cleaned_)?({known})_({known})_wk[^/\\]*$"
    first, second = (F.replace(F.regexp_extract(path, pattern, n), F.lit("_"), F.lit(" ")) for n in (1, 2))
    return F.when(path.rlike(pattern), F.struct(first.alias("first"), second.alias("second")))
