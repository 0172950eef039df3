"""Column names, placeholder literals and the fixed category lists.

The purchase schema is a configuration, not hard-wired: every operator takes a
``PurchaseSchema`` (default below) and reads column names from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source project's for equal results, so
# they are stated here as plain text, in their natural order, in one place.
# ---------------------------------------------------------------------------

# Placeholder literals that mean "no value", per raw column.
ARTIFICIAL_NULLS = {
    "place_origin_return": ["0", "", "NA", "None", "null"],
    "place_destination_return": ["0", "", "NA", "None", "null"],
    "fk_return_ota_bus_company": ["1", "", "NA", "None", "null"],
}

# Southern-hemisphere seasons by month.
SEASONS = {
    "verao": (12, 1, 2),
    "outono": (3, 4, 5),
    "inverno": (6, 7, 8),
    "primavera": (9, 10, 11),
}

# Parts of the day by hour, inclusive ranges.
DAYPARTS = {
    "madrugada": (0, 5),
    "manha": (6, 11),
    "tarde": (12, 17),
    "noite": (18, 23),
}

# Holiday windows as inclusive 'MM-dd' ranges; the first one wraps the year end.
HOLIDAY_WINDOWS = [("12-20", "01-05"), ("02-01", "03-15"), ("06-01", "06-30")]

# National fixed-date holidays (MM-dd) of the public calendar used for the festive flag;
# Good Friday and Carnival are derived from Easter.
NATIONAL_HOLIDAYS = ["01-01", "04-21", "05-01", "09-07", "10-12", "11-02", "11-15", "12-25"]
# Fixed dates that became holidays later: MM-dd -> first year.
NATIONAL_HOLIDAYS_SINCE = {"11-20": 2024}

# Weekday share suffixes, Monday first (weekday() = 0 is Monday).
WEEKDAY_NAMES = ["seg", "ter", "qua", "qui", "sex", "sab", "dom"]

# Cluster label words and thresholds.
LABEL_LOW, LABEL_MID, LABEL_HIGH = "Baixo", "Médio", "Alto"
LOW_THRESHOLD, HIGH_THRESHOLD = -0.5, 0.5
MAX_FRAGMENTS = 3
DEFAULT_CLUSTER_NAME = "Cluster"
NAME_SEPARATOR = " | "

# Readable names for features in cluster names.
DEFAULT_ALIASES = {
    "frequency_12m": "Frequência",
    "n_unique_routes_out": "Rotas",
    "avg_price_per_ticket": "Preço Médio",
    "top_route_out_share": "Foco na Rota",
    "top_company_out_share": "Foco na Viação",
    "pct_round_trip": "% Ida/Volta",
    "monetary_gmv_12m": "GMV",
    "total_tickets_12m": "Tickets",
    "pct_weekend": "% Fim‑de‑semana",
    "pct_q1": "% Q1", "pct_q2": "% Q2", "pct_q3": "% Q3", "pct_q4": "% Q4",
    "pct_verao": "% Verão", "pct_outono": "% Outono", "pct_inverno": "% Inverno", "pct_primavera": "% Primavera",
    "pct_madrugada": "% Madrugada", "pct_manha": "% Manhã", "pct_tarde": "% Tarde", "pct_noite": "% Noite",
    "pct_holiday": "% Feriados",
}

# Order in which features contribute fragments to a cluster name.
DEFAULT_PRIORITY = [
    "frequency_12m", "n_unique_routes_out", "avg_price_per_ticket",
    "top_route_out_share", "top_company_out_share", "pct_round_trip",
    "total_tickets_12m", "monetary_gmv_12m",
    "pct_weekend", "pct_q3", "pct_q1", "pct_q2", "pct_q4",
    "pct_verao", "pct_outono", "pct_inverno", "pct_primavera",
    "pct_noite", "pct_tarde", "pct_manha", "pct_madrugada",
    "pct_holiday",
]

# Defaults of the runs.
DEFAULT_TZ = "America/Sao_Paulo"
DEFAULT_BUILD_DATE = "2024-01-01"
DEFAULT_MODEL_VERSION = "v1"
DEFAULT_WINDOW_MONTHS = 12
DEFAULT_MIN_ROWS = 1000
DEFAULT_SKEW_THRESHOLD = 1.0
DEFAULT_FILL = 0.0
CONSTANT_EPS = 1e-12
DEFAULT_K_VALUES = list(range(2, 11))
DEFAULT_SEED = 42
DEFAULT_N_INIT = 10
DEFAULT_MAX_ITER = 300
DEFAULT_TOP_N = 15
DEFAULT_BUCKETS = 5
DEFAULT_MIN_HISTORY_DAYS = 14
DEFAULT_HORIZONS = (7, 30)
Z_SUFFIX = "_z"


@dataclass(frozen=True)
class PurchaseSchema:
    """Names of the raw purchase columns and of the derived ones."""

    key: str = "nk_ota_localizer_id"
    key_aliases: tuple = ("nk_ota_localizer_id", "nk_order_id")
    contact: str = "fk_contact"
    date: str = "date_purchase"
    time: str = "time_purchase"
    gmv: str = "gmv_success"
    tickets: str = "total_tickets_quantity_success"
    origin_out: str = "place_origin_departure"
    dest_out: str = "place_destination_departure"
    origin_ret: str = "place_origin_return"
    dest_ret: str = "place_destination_return"
    company_out: str = "fk_departure_ota_bus_company"
    company_ret: str = "fk_return_ota_bus_company"
    # derived
    ts: str = "purchase_datetime"
    row_id: str = "_row_id"
    route_out: str = "route_out"
    route_ret: str = "route_return"
    has_return: str = "has_return"
    avg_price: str = "avg_price_per_ticket"
    route: str = "route"
    artificial_nulls: dict = field(default_factory=lambda: dict(ARTIFICIAL_NULLS))

    @property
    def required(self) -> list:
        return [self.date, self.time, self.gmv, self.tickets]

    @property
    def string_columns(self) -> list:
        return [self.key, self.contact, self.origin_out, self.dest_out, self.origin_ret,
                self.dest_ret, self.company_out, self.company_ret]


DEFAULT_SCHEMA = PurchaseSchema()
