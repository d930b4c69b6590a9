"""Income-inequality analytics over large weighted microdata, as Spark DataFrame operators."""
