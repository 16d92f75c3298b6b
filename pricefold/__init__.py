"""pricefold: product-listing price analytics on Spark.

Listings are cleaned, matched to a product catalog and folded into one
price record per product, entirely as DataFrame / SQL plans.
"""

__version__ = "0.1.0"
