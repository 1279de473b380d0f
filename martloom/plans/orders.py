"""Order messages to a data vault and to per-user counters."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.keys import joined_text, uuid3_key, with_uuid3
from martloom.functions.text import plain_number
from martloom.operators.loads import upsert, with_literals
from martloom.operators.ranking import latest_per_key

# Numbers are read as text, so that hash differences see the digits of the message itself.
MESSAGE_SCHEMA = (
    "object_id string, object_type string, payload struct<"
    "id: bigint, date: string, cost: string, payment: string, status: string, "
    "user: struct<id: string, name: string, login: string>, "
    "restaurant: struct<id: string, name: string>, "
    "products: array<struct<id: string, name: string, category: string>>>"
)

# Message types, source label and the status that feeds the counters.
ORDER_TYPE = "order"
DOWNSTREAM_TYPE = "cdm_message"
SOURCE = "orders_kafka"
CLOSED = "CLOSED"


class VaultTable(NamedTuple):
    """Shape of a vault table.

    ``name`` are the message columns whose joined text the key is made of; a link is keyed by
    its ``parents`` instead, which map a stored hub key to the message column behind it.
    ``stored`` are message columns kept as they are, ``per_product`` tells whether the table
    needs the product lines.
    """

    pk: str
    name: tuple[str, ...]
    stored: tuple[str, ...]
    parents: dict[str, str]
    per_product: bool = False

    @property
    def inputs(self) -> list[str]:
        return list(dict.fromkeys([*self.name, *self.stored, *self.parents.values()]))

    @property
    def required(self) -> list[str]:
        return list(self.name) or list(self.parents.values())

    @property
    def versioned(self) -> bool:
        """Whether several different rows can share one key."""
        return len(self.inputs) > 1 and bool(self.name)

    @property
    def columns(self) -> list[str]:
        return [self.pk, *self.parents, *self.stored]


USER = {"h_user_pk": "user_id"}
PRODUCT = {"h_product_pk": "product_id"}
CATEGORY = {"h_category_pk": "category_name"}
RESTAURANT = {"h_restaurant_pk": "restaurant_id"}
ORDER = {"h_order_pk": "order_id"}

VAULT_TABLES = {
    "h_user": VaultTable("h_user_pk", ("user_id",), ("user_id",), {}),
    "h_product": VaultTable("h_product_pk", ("product_id",), ("product_id",), {}, True),
    "h_category": VaultTable("h_category_pk", ("category_name",), ("category_name",), {}, True),
    "h_restaurant": VaultTable("h_restaurant_pk", ("restaurant_id",), ("restaurant_id",), {}),
    "h_order": VaultTable("h_order_pk", ("order_id",), ("order_id", "order_dt"), {}),
    "l_order_product": VaultTable("hk_order_product_pk", (), (), {**ORDER, **PRODUCT}, True),
    "l_product_restaurant": VaultTable("hk_product_restaurant_pk", (), (), {**PRODUCT, **RESTAURANT}, True),
    "l_product_category": VaultTable("hk_product_category_pk", (), (), {**PRODUCT, **CATEGORY}, True),
    "l_order_user": VaultTable("hk_order_user_pk", (), (), {**ORDER, **USER}),
    "s_user_names": VaultTable(
        "hk_user_names_hashdiff", ("user_id", "username", "userlogin"), ("username", "userlogin"), USER
    ),
    "s_product_names": VaultTable(
        "hk_product_names_hashdiff", ("product_id", "product_name"), ("product_name",), PRODUCT, True
    ),
    "s_restaurant_names": VaultTable(
        "hk_restaurant_names_hashdiff", ("restaurant_id", "restaurant_name"), ("restaurant_name",), RESTAURANT
    ),
    "s_order_cost": VaultTable("hk_order_cost_hashdiff", ("order_id", "cost", "payment"), ("cost", "payment"), ORDER),
    "s_order_status": VaultTable("hk_order_status_hashdiff", ("order_id", "status"), ("status",), ORDER),
}


def parse_messages(raw: DataFrame, *keep: str) -> DataFrame:
    """Typed messages from the JSON in ``value``; ``keep`` columns ride along (offset, time).

    ``inline`` fixes the place of the parse: later filters stay above it and no message is
    parsed once per filtered field.
    """
    parsed = F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA)
    return raw.select(F.inline(F.array(parsed)), *keep)


def order_messages(messages: DataFrame) -> DataFrame:
    """Only order messages; a missing type or payload drops the row."""
    return messages.where((F.col("object_type") == ORDER_TYPE) & F.col("payload").isNotNull())


def order_rows(messages: DataFrame, *keep: str) -> DataFrame:
    """One flat row per order message, its products still in one array."""
    p = F.col("payload")
    return order_messages(messages).select(
        p["id"].alias("order_id"),
        p["date"].alias("order_dt"),
        plain_number(p["cost"]).alias("cost"),
        plain_number(p["payment"]).alias("payment"),
        p["status"].alias("status"),
        p["user"]["id"].alias("user_id"),
        p["user"]["name"].alias("username"),
        F.coalesce(p["user"]["login"], p["user"]["name"]).alias("userlogin"),
        p["restaurant"]["id"].alias("restaurant_id"),
        p["restaurant"]["name"].alias("restaurant_name"),
        p["products"].alias("products"),
        *keep,
    )


def product_rows(orders: DataFrame, *, whole: bool = False) -> DataFrame:
    """One row per product line of an order; ``line`` is its place in the message.

    With ``whole`` an order without products keeps one row, whose ``line`` and product columns are NULL.
    """
    explode = F.posexplode_outer if whole else F.posexplode
    lines = orders.select("*", explode("products").alias("line", "_product")).drop("products")
    return lines.select(
        "*",
        F.col("_product.id").alias("product_id"),
        F.col("_product.name").alias("product_name"),
        F.col("_product.category").alias("category_name"),
    ).drop("_product")


def vault_table(
    messages: DataFrame, table: str, load_dt: object, source: str = SOURCE, order_by: Sequence[str] = ()
) -> DataFrame:
    """One of the fourteen vault tables: a row per conflict key, the last message wins.

    Rows are reduced to distinct short business columns first and hashed afterwards, so a hot
    user or product costs about one row per task and the long keys are not shuffled for it.
    ``order_by`` names message columns (offset, time) that settle which version is last.
    """
    rows = order_rows(messages, *order_by)
    if VAULT_TABLES[table].per_product:
        rows = product_rows(rows)
    return table_of_rows(rows, table, load_dt, source, order_by)


def combined(rows: DataFrame, columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Each combination of the columns once, with the last of ``order_by``."""
    if not order_by:
        return rows.select(*columns).distinct()
    return rows.groupBy(*columns).agg(*[F.max(c).alias(c) for c in order_by])


def table_of_rows(
    rows: DataFrame, table: str, load_dt: object, source: str = SOURCE, order_by: Sequence[str] = ()
) -> DataFrame:
    """The vault table of flat rows that hold its columns and ``order_by``; see ``vault_table``.

    The rows may be whole ``product_rows``: lines without a product lack what product tables require.
    """
    spec = VAULT_TABLES[table]
    rows = combined(rows.dropna(subset=spec.required), spec.inputs, order_by if spec.versioned else ())
    if spec.versioned:
        rank_by = [*(order_by if order_by else ()), *spec.inputs]
        rows = latest_per_key(rows, [joined_text(*spec.name)], rank_by)
    if spec.parents:
        rows = with_uuid3(rows, {hub: [business] for hub, business in spec.parents.items()})
    rows = with_uuid3(rows, {spec.pk: spec.name or tuple(spec.parents)})
    return with_literals(rows.select(*spec.columns), load_dt=load_dt, load_src=source)


def order_vault(
    messages: DataFrame, load_dt: object, source: str = SOURCE, order_by: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """All fourteen tables from one frame of parsed messages; persist it if it is costly to read."""
    return {table: vault_table(messages, table, load_dt, source, order_by) for table in VAULT_TABLES}


def merge_vault_table(
    existing: DataFrame, incoming: DataFrame, table: str, *, first_seen: bool = False
) -> DataFrame:
    """Vault table after an upsert on its conflict key.

    The last load refreshes the other columns. A satellite keeps the parent key it was first stored
    with, and ``first_seen`` keeps the first load time and source too.
    """
    spec = VAULT_TABLES[table]
    keep = ["load_dt", "load_src"] if first_seen else []
    if table.startswith("s_"):
        keep.extend(spec.parents)
    return upsert(existing, incoming, [spec.pk], ["load_dt"], keep_first=keep)


def closed_order_items(messages: DataFrame, *keep: str, closed: str = CLOSED) -> DataFrame:
    """One row per product line of a closed order, with the keys the counters use."""
    return closed_line_items(product_rows(order_rows(messages, *keep)), *keep, closed=closed)


def closed_line_items(lines: DataFrame, *keep: str, closed: str = CLOSED) -> DataFrame:
    """The same from the product lines of orders."""
    return lines.where((F.col("status") == closed) & F.col("line").isNotNull()).select(
        uuid3_key("order_id").alias("order_id"),
        uuid3_key("user_id").alias("user_id"),
        uuid3_key("product_id").alias("product_id"),
        "product_name",
        uuid3_key("category_name").alias("category_id"),
        "category_name",
        "line",
        *keep,
    )


PAYLOAD = ["order_id", "user_id", "product_id", "product_name", "category_id", "category_name"]
DOWNSTREAM_SCHEMA = (
    "object_id string, object_type string, payload struct<" + ", ".join(f"{c}: string" for c in PAYLOAD) + ">"
)


def downstream_messages(items: DataFrame, object_id: Column | None = None) -> DataFrame:
    """JSON ``value`` per item for the next topic.

    ``object_id`` defaults to a random id. Give an expression built from the source offset and
    line where a replayed batch must produce the same ids, so that the reader can drop repeats.
    """
    envelope = F.struct(
        (F.uuid() if object_id is None else object_id).alias("object_id"),
        F.lit(DOWNSTREAM_TYPE).alias("object_type"),
        F.struct(*PAYLOAD).alias("payload"),
    )
    return items.select(F.to_json(envelope).alias("value"))


def parse_downstream(raw: DataFrame, *keep: str) -> DataFrame:
    """Items from downstream JSON, with their ``object_id``."""
    parsed = raw.select(F.from_json(F.col("value").cast("string"), DOWNSTREAM_SCHEMA).alias("m"), *keep)
    return parsed.select("m.object_id", "m.payload.*", *keep)


def user_counters(items: DataFrame, item_key: str, item_name: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Lines of closed orders per user and item (``product`` or ``category``) with the latest name.

    Product lines are counted, so an order with two lines of a category adds two.
    """
    last = F.struct(*order_by, item_name)
    return items.groupBy("user_id", item_key).agg(
        F.max_by(item_name, last).alias(item_name), F.count(F.lit(1)).alias("order_cnt")
    )


def user_product_counters(items: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    return user_counters(items, "product_id", "product_name", order_by)


def user_category_counters(items: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    return user_counters(items, "category_id", "category_name", order_by)
