"""Player-risk analytics on Spark: ingest, identity, linkage, features, rules, reviews and audits."""
