"""Reading raw statistic files and web pages, and writing marts."""
