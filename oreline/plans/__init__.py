"""Tables and queries of the two subject areas."""
