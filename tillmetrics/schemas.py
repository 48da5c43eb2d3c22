"""The four datasets: positional text columns and their typed form.

Files carry text in a fixed column order. ``typed_schema`` is what every plan works
on. ``scan_schema`` is what the CSV scan itself converts, once per row, and
``text_schema`` is the unconverted form for rows that have to be looked at as text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

CLIENT = "client_id"

# Dataset names, column order and file names of the input contract.
MENU_ITEMS = "menu_items"
TRANSACTION_ITEMS = "transaction_items"
TRANSACTIONS = "transactions"
USERS = "users"

_STRING, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_TIMESTAMP, _DATE = T.TimestampNTZType(), T.DateType()


@dataclass(frozen=True)
class Dataset:
    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    monthly: bool

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, _STRING) for name in self.names])

    @property
    def scan_schema(self) -> T.StructType:
        """Dates and plain integers by the scan; numbered ids (``"12.0"``) and amounts as text.

        Stores and payment methods stay text: they need not be numbers.
        """
        scanned = {_LONG: _STRING, _DOUBLE: _STRING}
        return T.StructType(
            [
                T.StructField(name, _STRING if name == "voucher_id" else scanned.get(kind, kind))
                for name, kind in self.columns
            ]
        )

    @property
    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind) for name, kind in self.columns])


DATASETS = {
    MENU_ITEMS: Dataset(
        MENU_ITEMS,
        (
            ("item_id", _LONG),
            ("item_name", _STRING),
            ("category", _STRING),
            ("price", _DOUBLE),
            ("is_seasonal", _STRING),
            ("available_from", _STRING),
            ("available_to", _STRING),
        ),
        monthly=False,
    ),
    TRANSACTION_ITEMS: Dataset(
        TRANSACTION_ITEMS,
        (
            ("transaction_id", _STRING),
            ("item_id", _LONG),
            ("quantity", _INT),
            ("unit_price", _DOUBLE),
            ("subtotal", _DOUBLE),
            ("created_at", _TIMESTAMP),
        ),
        monthly=True,
    ),
    TRANSACTIONS: Dataset(
        TRANSACTIONS,
        (
            ("transaction_id", _STRING),
            ("store_id", _STRING),
            ("payment_method_id", _STRING),
            ("voucher_id", _INT),
            ("user_id", _LONG),
            ("original_amount", _DOUBLE),
            ("discount_applied", _DOUBLE),
            ("final_amount", _DOUBLE),
            ("created_at", _TIMESTAMP),
        ),
        monthly=True,
    ),
    USERS: Dataset(
        USERS,
        (
            ("user_id", _LONG),
            ("gender", _STRING),
            ("birthdate", _DATE),
            ("registered_at", _TIMESTAMP),
        ),
        monthly=True,
    ),
}
