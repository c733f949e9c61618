"""Settings of the engine: rule thresholds, table layout, fixed values."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

# Rule names and their scores.
RULE_SCORES = {
    "HIGH_AMOUNT_NIGHT": 85,
    "ROUND_AMOUNT": 40,
    "INTERNATIONAL_HIGH_AMOUNT": 65,
    "VELOCITY_SPIKE": 75,
    "LOCATION_JUMP": 90,
    "DORMANT_REACTIVATION": 70,
}

# Defaults of newly met dimension members and alerts.
NEW_USER_KYC = "Level1"
NEW_USER_STATUS = "Active"
NEW_ALERT_STATUS = "NEW"
DEFAULT_TX_STATUS = "SUCCESS"

# Approximate centres of the provinces events come from: (latitude, longitude) in degrees.
PROVINCE_CENTRES = {
    "Metro Manila": (14.60, 120.98),
    "Cebu": (10.32, 123.89),
    "Davao del Sur": (7.07, 125.61),
    "Cavite": (14.28, 120.87),
    "Laguna": (14.17, 121.33),
    "Bulacan": (14.84, 120.81),
    "Pampanga": (15.03, 120.69),
    "Batangas": (13.76, 121.06),
    "Rizal": (14.59, 121.18),
    "Negros Occidental": (10.67, 122.95),
    "Iloilo": (10.72, 122.56),
    "Benguet": (16.41, 120.59),
    "Pangasinan": (16.04, 120.33),
    "Misamis Oriental": (8.48, 124.65),
    "Zamboanga del Sur": (7.83, 123.44),
    "South Cotabato": (6.11, 125.17),
    "Leyte": (11.24, 125.00),
    "Palawan": (9.74, 118.74),
    "Bohol": (9.65, 123.85),
}


@dataclass(frozen=True)
class Rules:
    """Thresholds of the fraud rules. All amounts are in pesos."""

    night_amount: int = 50_000
    night_from_hour: int = 0
    night_to_hour: int = 5
    round_amount: int = 10_000
    round_unit: int = 1_000
    international_amount: int = 30_000
    velocity_count: int = 10
    velocity_window: timedelta = timedelta(minutes=5)
    jump_km: float = 100.0
    jump_window: timedelta = timedelta(minutes=10)
    dormant_gap: timedelta = timedelta(days=180)
    dormant_amount: int = 20_000
    flag_score: int = 60
    monitor_score: int = 40


DEFAULT_RULES = Rules()


@dataclass(frozen=True)
class Lake:
    """Folder layout of the stored tables under one root."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def users(self) -> str:
        return self.table("silver/dim_users")

    @property
    def merchants(self) -> str:
        return self.table("silver/dim_merchants")

    @property
    def facts(self) -> str:
        return self.table("silver/fact_transactions")

    @property
    def quarantine(self) -> str:
        return self.table("silver/quarantine")

    @property
    def event_keys(self) -> str:
        return self.table("silver/event_keys")

    @property
    def user_keys(self) -> str:
        return self.table("silver/user_keys")

    @property
    def merchant_keys(self) -> str:
        return self.table("silver/merchant_keys")

    @property
    def activity(self) -> str:
        return self.table("silver/user_activity")

    @property
    def stretches(self) -> str:
        return self.table("silver/user_stretches")

    @property
    def decisions(self) -> str:
        return self.table("gold/alert_decisions")

    @property
    def alerts(self) -> str:
        return self.table("gold/mart_fraud_alerts")

    @property
    def user_daily(self) -> str:
        return self.table("gold/mart_daily_user_dashboard")

    @property
    def merchant_daily(self) -> str:
        return self.table("gold/mart_merchant_performance")

    @property
    def hourly(self) -> str:
        return self.table("gold/mart_hourly_velocity")

    def segmented(self) -> list[str]:
        """Tables that are searched by key in every load."""
        return [self.event_keys, self.user_keys, self.merchant_keys, self.stretches]

    @property
    def customers(self) -> str:
        return self.table("gold/mart_merchant_customers")

    @property
    def profiles(self) -> str:
        return self.table("gold/fact_profiles")

    @property
    def arrivals(self) -> str:
        """When each load began to store its rows: a folder per day, a small file per load."""
        return self.table("_arrivals")

    @property
    def touched(self) -> str:
        """Days whose facts have changed since their marts were built: a folder per day, a small file per load."""
        return self.table("_touched")

    def load_mark(self, load: str, step: str) -> str:
        """A small file that tells that a load has begun, or is done."""
        return self.table(f"_loads/{load}/{step}")

    def silver(self) -> list[str]:
        return [self.users, self.merchants, self.facts]

    def gold(self) -> list[str]:
        return [self.user_daily, self.merchant_daily, self.hourly, self.alerts]
