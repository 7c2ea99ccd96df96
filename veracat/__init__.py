"""An evidence catalog on Spark: ingest, check, publish and answer, as DataFrame operators."""
