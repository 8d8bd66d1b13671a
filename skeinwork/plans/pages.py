"""Page extraction queries over the web pages, and over product pages that are built from parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.operators import pages as H
from skeinwork.plans.registry import query
from skeinwork.sources.storage import table


BASE = "https://www.vendor.example.com"


def _choose(column, *cases):
    """The case that the column's value (from 0) names, as text."""
    out = F.lit("")
    for i, case in enumerate(cases):
        out = F.when(column == i, case if not isinstance(case, str) else F.lit(case)).otherwise(out)
    return out


def _join(*parts):
    return F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html, number, colors): a product page for each part. Pages differ in where they keep each field, and
    some lack it, by rules of the part's key."""
    # The parts are few bytes, their pages are many: deal the parts out before.
    p = table(spark, sf_dir, "part").repartition(spark.sparkContext.defaultParallelism, "p_partkey")
    k, price, name = F.col("p_partkey"), F.format_string("%.2f", "p_retailprice"), F.col("p_name")
    of = lambda n: k % n
    names = _choose(
        of(5), _join('<div id="productDetailsMain"><div><h3 class="text-primary big"> ', name, "</h3></div></div><h1>Shop</h1>"), _join('<h1 class="product-title">', name, "</h1>"), _join('<div class="product-name"><p><h1>', name, " </h1></div>"),
        _join('<h1 class="product-title"> </h1><h1 data-product-name>', name, "</h1>"), "<h2>nothing</h2>",
    )
    skus = _choose(of(4), _join('<span class="product-number ng-binding">Product #: ', k + 10000, "</span>"), _join('<b><span class="product-number">', k + 10000, "</span></b>"), _join('<i class="product-id">P-', k, "</i>"), "")
    descriptions = _choose(of(3), _join('<div class="product-description"><p>', F.col("p_type"), "</p></div>"), _join("<div data-product-description> ", F.col("p_type"), " </div>"), '<p class="other">no</p>')
    prices = _choose(of(4), _join('<div class="product-price"><strong>Price</strong><a class="ng-binding">$', price, "</a></div>"), _join('<div class="product-price"><strong>Price</strong><a>$', price, "</a></div>"), _join('<span class="price-range">$', price, "</span>"), "")
    cpns = F.when(of(3) == 0, _join('<div class="product-cpn">CPN-', k, "</div>")).otherwise("")
    images = _choose(of(3), _join('<div class="product-images"><img src="//img.example.com/400/', k, '.jpg"><img src="//img.example.com/400/', k, '.jpg"><img src="https://img.example.com/b.jpg"></div>'), _join('<img data-product-image src="https://img.example.com/', k, '.png">'), "")
    grid = F.when(of(6) == 5, "").otherwise(_join(
        "<table><tr><th>Quantity</th><th>", F.col("p_size"), "</th><th>1,000+</th><th>each</th></tr><tr><td>", F.col("p_brand"), "</td><td>$", price, F.when(of(2) == 0, '<small class="price-code">(R)</small>').otherwise(""),
        "</td><td>$1,", of(10), "34.50</td><td>$9.99</td></tr><tr><td>$5.00</td><td>$6.00</td></tr><tr><td>", F.col("p_type"), "</td><td>call</td><td>", of(7), ".25</td></tr></table>",
    ))
    attributes = _join(
        '<div class="attribute"><span class="label">Size:</span><span class="value">', F.col("p_size"), '</span></div><div class="attribute"><span class="label">Color</span><span class="value">', F.col("p_brand"), '</span><span class="value">', _join("Maker ", of(25)), "</span></div>",
    )
    shipping = _join(F.when(of(2) == 0, _join('<div ng-repeat="x in ProductionTime">', F.col("p_size") % 9, " days</div>")).otherwise(_join('<span class="shipping-time">', F.col("p_size") % 9, " days</span>")), F.when(of(3) == 1, '<p ng-if="HasRushService">Rush</p>').otherwise(""), F.when(of(4) != 0, _join('<p ng-if="x.Origin">', _join("Maker ", of(25)), "</p>")).otherwise(""))
    safety = _join(F.when(of(5) == 0, _join('<p class="warning">Choking ', k, "</p>")).otherwise(""), F.when(of(6) == 0, _join('<p ng-repeat="w in PROP">P65 ', F.col("p_size"), "</p>")).otherwise(""), F.when(of(4) == 1, _join('<span class="certification">C', of(8), '</span><span class="certification">D</span>')).otherwise(""))
    supplier = _join(
        '<div class="supplier"><span class="supplier-name">S', of(10), "</span> asi/", k % 100 + 30000, F.when(of(2) == 1, _join(' <i class="supplier-phone">555-', k, '</i><i class="supplier-fax">556-', k, "</i>")).otherwise(""), ' <a href="/about">x</a><a href="https://s', of(10), '.example.com">site</a></div>',
    )
    related = F.when(of(3) == 2, _join('<div class="related-item"><img src="/media/', k + 1, '.jpg">Other ', F.col("p_brand"), '</div><div class="related-item">Plain</div>')).otherwise("")
    art = _choose(
        of(6), _join(f'<a href="{BASE}/fs/artTemplates/N', k, '/front.pdf">Art</a>'), _join(f'<i data-x="{BASE}/artTemplates/N', k, '/back.pdf"></i>'), _join(f'<i data-x="{BASE}/fs/artTemplates/all-N', k, '-x.zip"></i>'),
        _join('<a href="/download/none.pdf">a</a><a href="/download/N', k, '.pdf">b</a>'), _join(f'<a href="{BASE}/fs/artTemplates/M', k, '/front.pdf">of another</a>'), "",
    )
    shown = _join(
        f'<i data-y="{BASE}/imageManager/show/N', k, f'_V1_front.jpg"></i><i data-y="{BASE}/fs/images/V1_', k, f'.png"></i><i data-y="{BASE}/imageManager/show/N', k, f'_Red_a.jpg"></i><img class="x" src="{BASE}/x/RED-', k, f'.gif"><img src="https://other.example.org/V1.jpg"><i data-y="{BASE}/fs/images/W9', k, '_1.gif"></i>',
    )
    number = F.when(of(7) == 6, "").otherwise(_join('data-product="{&quot;Number&quot;:&quot;N', k, '&quot;}"'))
    updated = F.when(of(5) == 4, "").otherwise(_join("<p>Last updated: 2025-07-", F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0"), "</p>"))
    html = _join("<html><head><title>Shop</title><script>var x = '<h1>no</h1>';</script></head><body ", number, ">", names, skus, descriptions, prices, cpns, images, grid, attributes, shipping, safety, supplier, related, art, shown, updated, "</body></html>")
    color = lambda name, vendor, sku: F.struct(F.lit(name).alias("Name"), F.lit(vendor).alias("VendorCode"), F.lit(sku).alias("SKU"), F.lit("c").alias("Code"))
    colors = F.array(color("Red", "V1", "S1"), color("Blue", "", "S2"), color("Green", "", ""))
    return p.select(k.alias("page_id"), _join("https://shop.example.com/", k).alias("url"), html.alias("html"), _join("N", k).alias("number"), colors.alias("colors"))


@query(f"""SELECT p_partkey AS page_id, CASE WHEN p_partkey % 5 = 4 THEN NULL ELSE trim(p_name) END AS name, CASE p_partkey % 4 WHEN 2 THEN 'P-' || p_partkey WHEN 3 THEN NULL ELSE (p_partkey + 10000)::VARCHAR END AS sku,
  CASE WHEN p_partkey % 3 < 2 THEN trim(p_type) END AS description, CASE WHEN p_partkey % 4 < 3 THEN '$' || printf('%.2f', p_retailprice) END AS price, CASE WHEN p_partkey % 3 = 0 THEN 'CPN-' || p_partkey END AS cpn,
  CASE p_partkey % 3 WHEN 0 THEN 'https://img.example.com/' || p_partkey || '.jpg' WHEN 1 THEN 'https://img.example.com/' || p_partkey || '.png' ELSE 'N/A' END AS main_image, (2 - p_partkey % 3) AS n_images,
  p_size || ';' || p_brand || ',Maker ' || (p_partkey % 25) AS attributes, (p_size % 9) || ' days' AS shipping_time, p_partkey % 3 = 1 AS rush, CASE WHEN p_partkey % 4 <> 0 THEN 'Maker ' || (p_partkey % 25) END AS origin,
  CASE WHEN p_partkey % 5 = 0 THEN 'Choking ' || p_partkey ELSE '' END AS warnings, CASE WHEN p_partkey % 6 = 0 THEN 'P65 ' || p_size END AS prop_65, CASE WHEN p_partkey % 4 = 1 THEN 'C' || (p_partkey % 8) || ',D' ELSE '' END AS certifications,
  'S' || (p_partkey % 10) AS supplier_name, (p_partkey % 100 + 30000)::VARCHAR AS asi_number, CASE WHEN p_partkey % 2 = 1 THEN '555-' || p_partkey END AS supplier_phone, CASE WHEN p_partkey % 2 = 1 THEN '556-' || p_partkey END AS supplier_fax,
  'https://s' || (p_partkey % 10) || '.example.com' AS supplier_link, CASE WHEN p_partkey % 3 = 2 THEN 'Other ' || p_brand || '|/media/' || (p_partkey + 1) || '.jpg|' || (p_partkey + 1) || ';Plain||-' ELSE '' END AS related,
  CASE WHEN p_partkey % 5 <> 4 THEN '2025-07-' || lpad((p_size % 28 + 1)::VARCHAR, 2, '0') END AS update_date,
  CASE WHEN p_partkey % 7 <> 6 THEN 'N' || p_partkey WHEN p_partkey % 4 < 2 THEN (p_partkey + 10000)::VARCHAR END AS product_number,
  CASE p_partkey % 6 WHEN 0 THEN '{BASE}/fs/artTemplates/N' || p_partkey || '/front.pdf' WHEN 1 THEN '{BASE}/artTemplates/N' || p_partkey || '/back.pdf' WHEN 2 THEN '{BASE}/fs/artTemplates/all-N' || p_partkey || '-x.zip'
    WHEN 3 THEN '{BASE}/download/N' || p_partkey || '.pdf' END AS art_template FROM part""")
def h1_extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 to H4, H7 to H12 and H14: one typed row per product page."""
    pages = product_pages(spark, sf_dir)
    found = H.extract_pages(pages, keep=["page_id", "url", "number", "html"])
    related = F.transform("related", lambda x: F.concat(x["name"], F.lit("|"), x["image"], F.lit("|"), F.coalesce(x["id"], F.lit("-"))))
    return found.select(
        "page_id", "name", "sku", "description", "price", "cpn", "main_image", F.size("images").alias("n_images"), F.concat(F.col("attributes")["Size"][0], F.lit(";"), F.array_join(F.col("attributes")["Color"], ",")).alias("attributes"), "shipping_time", "rush", "origin",
        F.array_join("warnings", ",").alias("warnings"), "prop_65", F.array_join("certifications", ",").alias("certifications"), "supplier_name", "asi_number", "supplier_phone", "supplier_fax", "supplier_link",
        F.array_join(related, ";").alias("related"), "update_date", "product_number", H.art_template(F.col("html"), F.col("number"), BASE).alias("art_template"),
    )


@query("""SELECT p_partkey AS page_id, p_brand AS label, p_size AS quantity, round(p_retailprice, 2) AS price, CASE WHEN p_partkey % 2 = 0 THEN 'R' END AS discount_code FROM part WHERE p_partkey % 6 <> 5
  UNION ALL SELECT p_partkey, p_brand, 1000, 1034.5 + 100 * (p_partkey % 10), NULL FROM part WHERE p_partkey % 6 <> 5 UNION ALL SELECT p_partkey, p_type, 1000, p_partkey % 7 + 0.25, NULL FROM part WHERE p_partkey % 6 <> 5""")
def h6_price_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.price_rows(product_pages(spark, sf_dir))


@query("SELECT page_id, nullif(trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')), '') AS heading, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS title, nullif(regexp_extract(html, '(?i)<a\\s[^>]*href=[\"'']([^\"'']*)[\"'']', 1), '') AS link FROM pages")
def h1_page_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", H.first_heading(F.col("html")).alias("heading"), H.title(F.col("html")).alias("title"), H.first_link(F.col("html")).alias("link"))


@query(f"""SELECT p_partkey AS page_id, 'Red' AS color, 'V1' AS vendor_code, i.pos AS pos, i.image AS image FROM part, LATERAL (VALUES
  (0, '{BASE}/imageManager/show/N' || p_partkey || '_V1_front.jpg'), (1, '{BASE}/imageManager/show/N' || p_partkey || '_Red_a.jpg'), (2, '{BASE}/fs/images/V1_' || p_partkey || '.png'), (3, '{BASE}/x/RED-' || p_partkey || '.gif')) i(pos, image)""")
def h5_color_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only one of three colors has images, in the order of the patterns; images of another host or kind are left out."""
    found = product_pages(spark, sf_dir).select("page_id", F.explode(H.color_images(F.col("html"), F.col("number"), F.col("colors"), BASE)).alias("c"))
    return found.select("page_id", "c.color", "c.vendor_code", F.posexplode("c.images").alias("pos", "image"))


@query("""SELECT p_partkey AS page_id, CASE WHEN p_partkey % 7 <> 6 THEN '{"Number":"N' || p_partkey || '"}' END AS product FROM part""")
def h13_embedded_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_pages(spark, sf_dir).select("page_id", H.embedded_json(F.col("html")).alias("product"))
