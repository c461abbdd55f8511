"""Source-shaped tables derived from the driver tables, so every operator runs on data that grows with them.

* survey answers from customers (segment = component of interest, balance = budget, nation = city),
* a CPU spec file from parts (alias-headed columns, null and duplicate models, trademark signs),
* alias-headed offer files from suppliers (homologation input),
* daily exchange-rate documents (JSON text) from the order calendar,
* storefront search pages (HTML) from the offers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake import rules


def survey_from_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Raw survey rows: negative balance -> empty budget, every 97th budget non-numeric, every 33rd city missing."""
    n = nation.select("n_nationkey", "n_name")
    c = customer.join(n, customer.c_nationkey == n.n_nationkey)
    k = F.col("c_custkey")
    return c.select(
        F.format_string("ENC-%04d", k).alias("id_anonimo"),
        F.when(k % 33 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("ciudad"),
        F.col("c_mktsegment").alias("categoria_interes"),
        F.when(k % 97 == 0, F.lit("n/a"))
        .when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_acctbal").cast("string")).alias("presupuesto_usd"),
    )


#: Market segment -> component category of the offers.
SEGMENT_COMPONENT = {"MACHINERY": "CPU", "BUILDING": "GPU", "AUTOMOBILE": "RAM", "HOUSEHOLD": "SSD", "FURNITURE": "Monitor"}


def component_survey(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """The survey with the component category that its segment stands for; other segments keep their name."""
    seg = F.col("categoria_interes")
    named = F.create_map(*[F.lit(x) for kv in SEGMENT_COMPONENT.items() for x in kv])
    return survey_from_customers(customer, nation).withColumn("categoria_interes", F.coalesce(F.try_element_at(named, seg), seg))


def spec_file_from_parts(part: DataFrame) -> DataFrame:
    """Spec-file-shaped rows keyed by ``p_partkey`` (file order)."""
    pk = F.col("p_partkey")
    cpu_model = F.concat(F.lit("AMD Ryzen™ "), (3 + 2 * (pk % 4)).cast("string"), F.lit(" "),
                         (5000 + 100 * (pk % 40)).cast("string"), F.lit("X"))
    model = (F.when(pk % 50 == 0, F.lit(None).cast("string"))
             .when(F.col("p_type") == "ECONOMY", cpu_model).otherwise(F.col("p_name")))
    return part.select(
        pk,
        model.alias("Model"),
        F.col("p_size").cast("string").alias("# of CPU Cores"),
        F.when(pk % 9 == 0, F.lit(None).cast("string")).otherwise((F.col("p_size") * 2).cast("string")).alias("# of Threads"),
        F.concat((F.col("p_size") * 5).cast("string"), F.lit(" W")).alias("Default TDP"),
        F.concat((F.col("p_size") % 5 + 2).cast("string"), F.lit("."), (pk % 10).cast("string"), F.lit(" GHz")).alias("Base Clock"),
        F.col("p_brand").alias("CPU Socket"),
        F.col("p_type").alias("Family"),
    )


def alias_offers_from_suppliers(supplier: DataFrame) -> DataFrame:
    """Offer file with alias headers (``store, nombre, name, price, url, fecha``) and no country/currency/category."""
    sk = F.col("s_suppkey")
    return supplier.select(
        sk,
        F.col("s_name").alias("store"),
        F.when(sk % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Item "), sk.cast("string"))).alias("nombre"),
        F.concat(F.lit("Producto "), sk.cast("string")).alias("name"),
        F.col("s_acctbal").cast("string").alias("price"),
        F.concat(F.lit("https://shop.example/s/"), sk.cast("string")).alias("url"),
        F.lit("2026-06-30 10:00:00").alias("fecha"),
    )


def fx_documents_from_orders(orders: DataFrame) -> DataFrame:
    """One exchange-rate document per order month: ``{"base":"USD","rates":{"<date>":{"<cur>":rate}}}`` as JSON text.

    Rates vary with the day of year: ``fallback * (1 + (doy % 10) / 1000)`` rounded to 6 decimals. Documents are
    built with ``to_json`` so that the reader below parses real JSON text.
    """
    d = F.to_date("o_orderdate")
    days = orders.select(d.alias("fecha")).distinct()
    m = F.create_map(*[x for c, r in rules.FALLBACK_RATES.items()
                       for x in (F.lit(c), F.rint(F.lit(r) * (1 + (F.dayofyear("fecha") % 10) / F.lit(1000.0)) * 1e6) / 1e6)])
    per_day = days.select(F.date_format("fecha", "yyyy-MM").alias("mes"), F.date_format("fecha", "yyyy-MM-dd").alias("dia"),
                          m.alias("rates"))
    docs = per_day.groupBy("mes").agg(F.map_from_entries(F.collect_list(F.struct("dia", "rates"))).alias("rates"))
    return docs.select("mes", F.to_json(F.struct(F.lit(rules.BASE_CURRENCY).alias("base"), "rates")).alias("doc"))


def storefront_pages(offers: DataFrame, orders_per_page: int = 4) -> DataFrame:
    """Search pages (HTML) of the offers: a page lists one category's offers of ``orders_per_page`` neighbouring orders in order.

    An offer without a readable price has no price element, one without an address no link; titles carry HTML entities; a menu
    and a nested list surround the items.
    """
    def escaped(c):
        return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    title = F.concat(F.lit('<h2 class="woocommerce-loop-product__title">\n  <b>'), escaped(F.col("producto")), F.lit("</b> &amp; m&aacute;s</h2>"))
    linked = F.when(F.col("url_producto").isNull(), title).otherwise(F.concat(F.lit('<a class="x" href="'), F.col("url_producto"), F.lit('">'), title, F.lit("</a>")))
    price = F.when(F.col("precio_raw") == "Consultar", F.lit("")).otherwise(
        F.concat(F.lit('<span class="price new"><bdi>'), F.col("precio_raw"), F.lit("</bdi></span>")))
    item = F.concat(F.lit('<li class="product type-a">'), linked, price, F.lit("<ul><li>detalle</li></ul></li>"))
    category = F.upper(F.trim("categoria"))
    rows = offers.select(F.floor(F.col("k1") / orders_per_page).cast("long").alias("grupo"), category.alias("categoria"), "pais", "fecha_extraccion",
                         F.struct("k1", "k2", item.alias("item")).alias("it"))
    # dealt by page first: lists begun before the shuffle would be sorted and spilled there, and save nothing
    g = rows.repartition("grupo", "categoria").groupBy("grupo", "categoria").agg(
        # at most orders_per_page orders with a few lines each
        F.sort_array(F.collect_list("it")).alias("its"), F.min("pais").alias("pais"), F.min("fecha_extraccion").alias("fecha_extraccion"))
    host = F.concat(F.lit("tienda"), (F.col("grupo") % 50).cast("string"))
    body = F.array_join(F.col("its")["item"], "\n")
    return g.select(
        F.concat_ws("-", F.col("grupo").cast("string"), "categoria").alias("pagina"), host.alias("tienda"), "pais", F.lit("USD").alias("moneda"), "categoria",
        F.lower("categoria").alias("keyword_busqueda"), F.concat(F.lit("https://"), host, F.lit(".example/?s="), F.lower("categoria")).alias("url"), "fecha_extraccion",
        F.concat(F.lit('<!DOCTYPE html><html><head><script>var t="<li class=product>";</script></head><body><nav><ul><li><a href="/inicio">Inicio</a></li></ul></nav>'
                       '<ul class="products">'), body, F.lit("</ul><!-- <li class=\"product\"> --></body></html>")).alias("html"))
