from wardstat.plans.runner import main

main()
