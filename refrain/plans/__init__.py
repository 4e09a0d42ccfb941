"""Views, jobs and the registered queries."""
