"""Scans: pages, seeds, sitemaps, robots files, office documents, earlier runs."""
