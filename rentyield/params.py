"""Run parameters (IO12).

Money parameters are kept as decimal text so the revenue model is computed in
exact decimal arithmetic inside Spark (365 x 0.70 is 255.5, not
255.49999999999997) and literals fold in Catalyst.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction


@dataclass(frozen=True)
class Assumptions:
    """Revenue-model parameters; defaults are the reference's published ones."""

    occupancy_rate: str = "0.70"      # share of nights booked
    service_fee_pct: str = "0.03"     # host fee on gross
    cleaning_cost: str = "30.0"       # per turnover
    avg_stay_nights: str = "3.0"      # nights per booking
    months_occupied: int = 11         # let: months rented per year
    maintenance_pct: str = "0.10"     # let: reserve on gross

    def occupied_nights(self) -> Decimal:
        return Decimal(365) * Decimal(self.occupancy_rate)

    def cleaning_per_year(self, scale: int = 6) -> Decimal:
        """Turnovers x cost per turnover, exact then fixed to ``scale`` places."""
        f = Fraction(365) * Fraction(self.occupancy_rate) / Fraction(self.avg_stay_nights) \
            * Fraction(self.cleaning_cost)
        q = Decimal(f.numerator) / Decimal(f.denominator)
        return q.quantize(Decimal(1).scaleb(-scale))


@dataclass(frozen=True)
class Bounds:
    """Outlier bounds. Price bounds are inclusive-valid, rent bounds strict."""

    price_lo: float = 10.0
    price_hi: float = 2000.0
    rent_lo: float = 100.0
    rent_hi: float = 5000.0


@dataclass(frozen=True)
class Labels:
    """Texts of the recommendation. Those the published results use."""

    stay: str = "Airbnb"
    let: str = "Kamernet"
    no_stay: str = "Kamernet (no Airbnb data)"
    no_let: str = "Airbnb (no Kamernet data)"


@dataclass(frozen=True)
class Paths:
    """Where raw files land and where layer tables are written.

    ``tables`` is a folder (parquet per table) or, when ``database`` is set, tables
    are saved to the session catalog under that database.
    """

    raw: str
    tables: str
    # The input file names the source drops use.
    listings_file: str = "airbnb.csv"
    rentals_file: str = "rentals.json"
    zones_file: str = "geo/post_codes.geojson"
    database: str | None = None
    city: str = "amsterdam"
    partition_rentals_by_city: bool = True   # bronze rentals partitioned: the city filter prunes files
    zones_per_line: bool = False             # one GeoJSON feature per line: the read splits
    zones_split: bool = True                 # one GeoJSON document: read in splits where it can be cut
    rentals_multiline: bool = True           # one JSON array per file (one task per file);
                                             # False reads JSON lines, which split across tasks
