"""Column names, schemas, fixed values and business rules kept as data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- numeric types ---------------------------------------------------------
RAW = T.DecimalType(38, 10)     # a parsed amount before rounding
MONEY = T.DecimalType(30, 2)    # a rounded amount
RATE = T.DecimalType(28, 8)     # an exchange rate, 1 EUR = rate
# Types of nearly all amounts and rates: their quotients and products keep more decimals.
USUAL_MONEY = T.DecimalType(20, 2)
USUAL_RATE = T.DecimalType(18, 8)

# --- column sets -----------------------------------------------------------
COMMON = ["platform", "operator", "brand", "username", "month", "currency"]
ADAPTED = COMMON + ["vendor_name", "rs_amount", "cpa_amount"]
UNION_KEYS = ["platform", "operator", "username", "month"]
RATE_COLUMNS = ["month", "quote_ts", "base_code", "currency", "rate"]
RUN_LOG_COLUMNS = ["run_at", "month", "step", "returncode", "status", "duration"]
DIVERGENCE_COLUMNS = ["platform", "operator", "username", "brand"]


def strings(*names: str) -> T.StructType:
    """A schema whose columns are all text, as every report scan is."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ACCOUNTS = strings("account_id", "platform", "operator", "brand", "username",
                   "url", "file_name", "active")
REFERENCE = strings("operator", "username", "brand", "ref", "netting")
RATE_HISTORY = strings(*RATE_COLUMNS)
WIDE_REPORT = strings(*COMMON, "row_month", "rs_reward", "cpa_reward", "reward_due")
LONG_REPORT = strings(*COMMON, "commission_type", "amount")
VENDOR_REPORT = strings(*COMMON, "row_currency", "vendor_name",
                        "revshare_commission", "cpa_commission")
MULTILINGUAL_REPORT = strings("platform", "operator", "brand", "account_username",
                              "month", "currency", "pct_commission", "cpa_commission")
RATE_FEED = T.StructType([
    T.StructField("time_last_update_utc", T.StringType()),
    T.StructField("base_code", T.StringType()),
    T.StructField("conversion_rates", T.MapType(T.StringType(), T.DoubleType())),
])

# Published column names, in output order, with their source column.
PUBLISHED = {
    "Index": "row_key",
    "AnoMes": "month",
    "Marca": "brand",
    "Plataforma": "platform",
    "Automatizado": "automated",
    "ReferenciaFacturacion": "ref",
    "Origen": "origin",
    "Operador": "operator",
    "Login": "username",
    "Resta": "netting",
    "Moneda_Operador": "currency",
    "ValorMoneda_XE": "rate",
    "RS_Operador": "rs_amount",
    "RS_EUR": "rs_eur",
    "CPA_Operador": "cpa_amount",
    "CPA_EUR": "cpa_eur",
    "TotalFacturacion_Operador": "total_amount",
    "TotalFacturacion_EUR": "total_eur",
}

# Labels written to the published table.
AUTOMATED_LABEL = "Sí"
NETTING_YES = "Sí"
NETTING_NO = "No"
PENDING_TEXT = "Esperar cambio"

# Currency markers, most specific first.
CURRENCY_MARKERS = [
    ("R$", "BRL"), ("€", "EUR"), ("£", "GBP"), ("COP", "COP"), ("MXN", "MXN"),
    ("PEN", "PEN"), ("ARS", "ARS"), ("CLP", "CLP"), ("USD", "USD"), ("$", "USD"),
]

# Commission types every long report must show.
DEFAULT_COMMISSION_TYPES = ["CPA", "Revshare Ongoing PL"]

# Multilingual report headers (lower case) and canonical names.
HEADER_NAMES = {
    "rowid": ["rowid"],
    "currency": ["currency symbol", "currencysymbol", "símbolo da moeda"],
    "total_records": ["total records", "totalrecords"],
    "affiliate_id": ["affiliate id", "id do afiliado", "identidad del afiliado"],
    "affiliate_username": ["username", "nome de usuário", "nombre de usuario"],
    "country": ["country", "país"],
    "impressions": ["impressions", "impressões", "impresiones"],
    "clicks": ["clicks", "cliques"],
    "click_through_ratio": ["click-through ratio", "porcentagem de cliques",
                            "porcentaje de 'click-through'"],
    "registrations": ["registrations", "registros", "descargas"],
    "registration_ratio": ["registration ratio", "porcentagem de registros",
                           "porcentaje de 'descargas'"],
    "deposits": ["deposits", "depósitos", "depositos"],
    "net_revenue": ["net revenue", "netrev", "receita liquida", "ingresos de red"],
    "gross_revenue": ["gross revenue", "rendimento bruto", "ingresos brutos"],
    "total_bets_hands": ["total bets/hands", "total de apuestas / manos"],
    "stake": ["stake", "apuestas"],
    "net_points": ["net points"],
    "pct_commission": ["% commission", "%commission", "% de comissão",
                       "porcentaje de comisión"],
    "cpa_commission": ["cpa commission", "comissão cpa",
                       "comisión coste de adquisición"],
    "cpa_count": ["cpa count", "conta cpa"],
    "referral_commission": ["referral commission", "comissão de referentes",
                            "comisión de referido"],
    "total_commission": ["total commission", "comissão total", "comisión total"],
    "bonus": ["bonus", "bônus"],
    "chargebacks": ["chargebacks", "estorno", "chargebacks 'reembolsos fraudulentos'"],
    "installs": ["installs"],
    "member_id": ["memberid"],
    "wagers": ["wagers"],
    "comm_admin_fee": ["commadminfee"],
    "adjustments": ["adjustments"],
    "costs": ["costs"],
    "new_account_ratio": ["new account ratio"],
    "new_depositing_acc_count": ["new depositing acc count"],
    "new_active_acc_count": ["new active acc count"],
    "first_deposit_count": ["first deposit count"],
    "active_accounts": ["active accounts"],
    "active_days": ["active days"],
    "new_acc_purchases": ["new acc purchases"],
    "depositing_accounts": ["depositing accounts"],
    "wagering_accounts": ["wagering accounts"],
    "average_active_days": ["average active days"],
    "gross_per_player": ["gross / player"],
    "net_per_player": ["net / player"],
    "merchant": ["merchant"],
}
HEADER_MAP = {h: canon for canon, headers in HEADER_NAMES.items() for h in headers}

# Measure headers of the platform exports and their report columns.
MEASURE_HEADERS = {
    "Revenue Share Reward": "rs_reward",
    "CPA Reward": "cpa_reward",
    "Reward Due": "reward_due",
    "Vendor Name": "vendor_name",
    "RevShare Commission": "revshare_commission",
    "CPA Commission": "cpa_commission",
}

# Text columns left empty in a zero row (lower-case raw headers).
ZERO_ROW_TEXT = ["rowid", "currency symbol", "affiliate id", "username", "country"]

# Reference worksheet header row and columns read by name.
SHEET_HEADER_ROW = 9
SHEET_COLUMNS = {
    "platform": "Plataforma",
    "username": "Usuario Referencia",
    "ref": "Operador Referencia",
    "commission": "RS / CPA / Fijo",
    "netting": "Resta",
}
# Order of the worksheet's commission kinds, and its platforms.
COMMISSION_RANK = {"rs": 0, "cpa": 1}
# The sheet spells platforms with spaces; compare after trimming and lower-casing.
USED_PLATFORMS = ["netrefer", "income access", "cellxpert", "raventrack"]


# --- business rules --------------------------------------------------------
@dataclass(frozen=True)
class MeasureOverride:
    """On this operator, CPA is read from another column and revenue share is 0."""
    operator: str
    cpa_column: str


@dataclass(frozen=True)
class AccountRename:
    """Rows of this operator in this currency belong to another username."""
    operator: str
    currency: str
    username: str


@dataclass(frozen=True)
class Rebase:
    """Amounts of this brand reported in one currency are restated in another."""
    brand: str
    reported: str
    restated: str


@dataclass(frozen=True)
class VendorKey:
    """Rows of this operator and brand meet the reference by vendor name."""
    operator: str
    brand: str


@dataclass(frozen=True)
class PendingFx:
    """Amounts of this login wait for a rate that arrives after the month closes."""
    platform: str
    username: str


@dataclass(frozen=True)
class Rules:
    """Every deployment-specific rule. Rows naming the owner's own brands and
    logins have no default: they come from the rule file (see sources.tables)."""
    operator_aliases: dict = field(default_factory=dict)
    default_currency: str = "EUR"
    brand_currency: dict = field(default_factory=dict)
    measure_overrides: tuple = ()
    account_renames: tuple = ()
    rebases: tuple = ()
    vendor_keys: tuple = ()
    pending: tuple = ()
    sheet_tabs: dict = field(default_factory=dict)      # worksheet tab -> brand
    used_platforms: tuple = tuple(USED_PLATFORMS)
