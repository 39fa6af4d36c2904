"""Point-in-time lake of regulatory ownership disclosures, on Spark DataFrames."""
