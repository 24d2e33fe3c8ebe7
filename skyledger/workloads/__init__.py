"""The registered queries, over flights made from the driver's tables, and their check SQL."""
