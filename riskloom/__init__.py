"""riskloom: behavioural risk analytics expressed as Spark DataFrame plans."""
